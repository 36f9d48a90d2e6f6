"""Whole texts to token ids through the tokenizers library, with a bounded memory of encoded words.

Both tokenizers here split a text before they merge, and a place where white space follows anything else always is
such a split. So a text may be cut there, each piece encoded by the library once, and the ids put side by side. A text
that holds a special token or unusual white space goes through the library whole.
"""

import os
import re
from array import array
from operator import attrgetter

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: White space and what follows it, for texts whose only white space is blanks and line ends.
PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Other white space, in any of the meanings that Python or the tokenizers give the term.
UNUSUAL = re.compile("[^\\S \n]")
#: Letters that every Unicode version calls letters, with the blank before and the marks behind: two splits at most.
PLAIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?&$%#*]*)")
#: Those marks, and the id of a token that the merges give.
MARKS, ID = ".,;:!?&$%#*", attrgetter("id")
#: Pieces that an encoder remembers, unless told otherwise.
LIMIT = 800_000


def default_path(name):
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Known(dict):
    """The ids of pieces; those of a piece asked for the first time are learnt, so pieces are looked up only once."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, key):
        ids = self[key] = self.learn(key)
        return ids


class Encoder:
    """encode(texts) gives each text's ids as little-endian unsigned 32-bit integers.

    `drops_space`: the tokenizer drops white space and case, so words are pieces; otherwise a piece keeps the white
    space before it. At most about `limit` pieces are remembered; beyond, the memory starts afresh.
    """

    def __init__(self, path, drops_space, limit=LIMIT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.drops_space, self.limit, self.known = drops_space, limit, Known(self.learn)
        self.merge = self.tokenizer.model.tokenize
        self.shown, self.blank = str.maketrans(dict(enumerate(byte_alphabet()))), byte_alphabet()[32]

    def pieces(self, text):
        """The keys of a text's pieces, or the text alone where it must be encoded whole.

        Where white space counts, a key stands for itself behind a blank, or just for itself if it starts with a line
        end, or for what follows the \\r that it starts with.
        """
        flat = text.replace("\n", " " if self.drops_space else " \n")
        if not (flat.replace("\n", "").isprintable() or not UNUSUAL.search(text)) or any(s in text for s in self.special):
            return [text]
        if self.drops_space:
            return flat.split()
        if "  " in flat or "\n " in flat or flat[:1] == " " or flat[-1:] in (" ", "\n"):
            return ["\r" + p for p in PIECE.findall(text)]
        keys = flat.split(" ")
        keys[0] = "\r" + keys[0]
        return keys

    def library(self, texts):
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, stem):
        """The ids of one plain word: nothing to normalise but its case, nothing to split."""
        if self.drops_space:
            stem = stem.lower()
        shown = stem.replace(" ", self.blank) if stem.isascii() else stem.encode().decode("latin-1").translate(self.shown)
        return array("I", list(map(ID, self.merge(shown)))).tobytes()

    def learn(self, key):
        """The ids of a piece: those of plain words by the merges alone, with those of the marks behind, others through the
        whole library."""
        stem = key.rstrip(MARKS)
        if stem.isascii() and stem.isalpha():
            if stem == key:
                return self.word(key if self.drops_space else " " + key)
            behind = key[len(stem):]
            return self.known[stem] + self.known[behind if self.drops_space else "\r" + behind]
        if self.drops_space or key[:1] == "\n":
            piece = key
        else:
            piece = key[1:] if key[:1] == "\r" else " " + key
        plain = PLAIN.fullmatch(piece)
        if not plain:
            return self.library([piece])[0]
        stem, marks = plain.groups()
        if not marks:
            return self.word(stem)
        at = stem if self.drops_space else stem[1:] if stem[0] == " " else "\r" + stem
        return self.known[at] + self.known[marks if self.drops_space else "\r" + marks]

    def encode(self, texts):
        if len(self.known) > self.limit:
            self.known.clear()
        cut = [self.pieces(t) for t in texts]
        whole = [i for i, (p, t) in enumerate(zip(cut, texts)) if len(p) == 1 and p[0] is t]
        of_whole = dict(zip(whole, self.library([texts[i] for i in whole])))
        known = self.known.__getitem__
        return [of_whole[i] if i in of_whole else b"".join(map(known, p)) for i, p in enumerate(cut)]


def byte_alphabet():
    """The character that stands for each byte in a byte-level vocabulary: itself if it is visible, else the next free
    one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def byte_strings(path):
    """The bytes that each id of a byte-level vocabulary stands for; ids without a token give none."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    back = {c: b for b, c in enumerate(byte_alphabet())}
    added = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    table = [b""] * (max(tokenizer.get_vocab().values()) + 1)
    for token, i in tokenizer.get_vocab().items():
        table[i] = added[i] if i in added else bytes(back[c] for c in token)
    return table


_encoders = {}


def encoder(path, drops_space, limit=LIMIT):
    """The worker's encoder of a file; later tasks of the same worker find it warm."""
    key = (path, drops_space)
    if key not in _encoders:
        _encoders[key] = Encoder(path, drops_space)
    _encoders[key].limit = limit
    return _encoders[key]


def forget():
    """Drop the worker's encoders: an operator that needs its memory for something else leaves no more than its own behind."""
    for codes in _encoders.values():
        codes.known.clear()
    _encoders.clear()
