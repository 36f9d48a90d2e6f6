"""The prefix log against a plain running average, and what its writes and reads touch."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridflow.operators.orders import resolve, with_running_average
from gridflow.sinks import prefix_log
from gridflow.sinks.prefix_log import ConcurrentWrite, PrefixLog
from test_keyed import orders

PRICE = "decimal(12,2)"


def made(rng, seqs):
    return [(n, f"O{n}", "p", str(rng.randrange(10 ** 6) / 100) if rng.random() < 0.9 else "-1", rng.choice([0, 0, 1, 3]), None)
            for n in seqs]


def shown(rows):
    return sorted(tuple(r) for r in rows.select("seq", "total_orders", "total_rejects", "cumulative_price", "running_avg").collect())


@pytest.mark.parametrize("bits, fan, price", [(3, 1, PRICE), (5, 2, PRICE), (17, 8, PRICE), (4, 2, "double")])
def test_late_and_corrected_orders(spark, tmp_path, bits, fan, price):
    rng = random.Random(bits)
    log, known = PrefixLog(spark, str(tmp_path), bits, fan), {}
    for seqs in (range(40, 60), range(0, 200, 3), [5000], [41, 43, 5001, 7], range(190, 230)):
        rows = made(rng, seqs)
        known |= {r[0]: r for r in rows}
        log.write(resolve(orders(spark, rows), price_type=price))
        wanted = with_running_average(resolve(orders(spark, list(known.values())), price_type=price))
        found = shown(log.read())
        if price == "double":
            assert [(r[:3], pytest.approx(r[3])) for r in found] == [(r[:3], r[3]) for r in shown(wanted)]
        else:
            assert found == shown(wanted)
    total = {r.seq: r for r in log.read().collect()}
    assert log.end()["seq"] == 5001 and log.end()["prior_orders"] == total[5001].total_orders
    for seq in (0, 41, 199, 5000, 10 ** 6):
        earlier = [r for n, r in total.items() if n >> bits < seq >> bits]
        assert log.before(seq)[:2] == max(((r.total_orders, r.total_rejects) for r in earlier), default=(0, 0))
    assert shown(log.read(45, 197)) == [r for r in shown(log.read()) if 45 <= r[0] <= 197]
    assert log.read(300, 400).isEmpty() and log.write(resolve(orders(spark, []), price_type=price)) == []


def test_a_late_order_reads_and_rewrites_one_bucket(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    log = PrefixLog(spark, str(tmp_path), bits=4, fan=2)
    log.write(resolve(orders(spark, made(rng, range(0, 1024, 2))), price_type=PRICE))
    read, nodes = [], []
    monkeypatch.setattr(PrefixLog, "_read", lambda self, folders, schema=None, f=PrefixLog._read: read.extend(folders) or f(self, folders, schema))
    monkeypatch.setattr(PrefixLog, "_make", lambda self, *a, f=PrefixLog._make: nodes.append(a[0]) or f(self, *a))
    assert log.write(resolve(orders(spark, made(rng, [501])), price_type=PRICE)) == [501 >> 4]
    assert [f.split("/")[1] for f in read] == ["_bucket=31"] and nodes == [0, 1, 2]   # 64 buckets: one node on each of three levels
    read.clear()
    plan = log.read(600, 610)
    assert len(read) == 2 and {f.split("_bucket=")[1].split("/")[0] for f in plan.inputFiles()} == {"37", "38"}
    loads = []
    monkeypatch.setattr(PrefixLog, "_load", lambda self, s, f=PrefixLog._load: loads.append(s["name"]) or f(self, s))
    log.before(700)
    assert len(loads) == 3


def test_of_two_writers_one_succeeds(spark, tmp_path):
    rng = random.Random(4)
    one, other = (PrefixLog(spark, str(tmp_path), bits=4, fan=2) for _ in range(2))
    one.write(resolve(orders(spark, made(rng, range(10))), price_type=PRICE))
    name, root = other._root()
    one.write(resolve(orders(spark, made(rng, range(10, 20))), price_type=PRICE))
    other._root = lambda: (name, root)
    with pytest.raises(ConcurrentWrite):
        other.write(resolve(orders(spark, made(rng, range(30, 40))), price_type=PRICE))
    assert PrefixLog(spark, str(tmp_path), bits=4, fan=2).read().count() == 20


def test_replaced_files_are_swept_when_readers_have_passed(spark, tmp_path):
    rng = random.Random(5)
    log = PrefixLog(spark, str(tmp_path), bits=4, fan=2)
    log.write(resolve(orders(spark, made(rng, range(40))), price_type=PRICE))
    before = log.read()
    log.manifest.passed("report", log.manifest.state()["version"])
    log.write(resolve(orders(spark, made(rng, [3])), price_type=PRICE))
    assert log.sweep() == [] and before.count() == 40
    log.manifest.passed("report", log.manifest.state()["version"])
    assert len(log.sweep()) == 1 and log.read().count() == 40
    assert len(list((tmp_path / "rows").glob("*/_bucket=0/*.parquet"))) == 1


def test_totals_are_exact(spark, tmp_path):
    log = PrefixLog(spark, str(tmp_path), bits=1, fan=1)
    price = "decimal(24,6)"
    rows = [(n, f"O{n}", "p", "99999999999999999.000001", 0, None) for n in range(12)]
    log.write(resolve(orders(spark, rows), price_type=price))
    assert log.end()["prior_total"] == 12 * Decimal("99999999999999999.000001")
    assert log.read().agg(F.max("cumulative_price")).first()[0] == 12 * Decimal("99999999999999999.000001")
    with pytest.raises(ValueError, match="below zero"):
        log.write(resolve(orders(spark, [(-1, "O", "p", "1", 0, None)]), price_type=price))
    assert prefix_log.EXACT.prec >= 38 * 2


def test_many_buckets_are_few_node_files(spark, tmp_path, monkeypatch):
    """What the driver writes does not grow by a file per node, packs go with their last node, and a log from before goes on."""
    rng = random.Random(6)
    log, files = PrefixLog(spark, str(tmp_path), bits=1, fan=1), lambda: len(list((tmp_path / "nodes").glob("*.json")))
    rows = made(rng, range(256))
    log.write(resolve(orders(spark, rows), price_type=PRICE))
    assert files() == 2                                              # 127 nodes in one pack, and the root
    monkeypatch.setattr(prefix_log, "PACK_CHILDREN", 64)
    again = made(rng, range(256))
    log.write(resolve(orders(spark, again), price_type=PRICE))
    log.sweep()
    assert files() == 1 + 4 and log.read().count() == 256            # 254 children; the first pack is gone
    assert shown(log.read()) == shown(with_running_average(resolve(orders(spark, again), price_type=PRICE)))
    late = made(rng, [7])
    log.write(resolve(orders(spark, late), price_type=PRICE))
    log.sweep()
    wanted = [r for r in again if r[0] != 7] + late
    assert shown(PrefixLog(spark, str(tmp_path), bits=1, fan=1).read()) == shown(with_running_average(resolve(orders(spark, wanted), price_type=PRICE)))


def test_a_log_with_a_file_per_node_goes_on(spark, tmp_path):
    rng = random.Random(7)
    log = PrefixLog(spark, str(tmp_path), bits=2, fan=1)
    log.write(resolve(orders(spark, made(rng, range(32))), price_type=PRICE))
    name, root = log._root()
    split = lambda s: {**s, "name": unpacked(s)}

    def unpacked(summary):
        node = log._load(summary)
        children = {i: split(c) if node["level"] else c for i, c in node["children"].items()}
        old = summary["name"].replace("#", "-")
        (tmp_path / "nodes" / f"{old}.json").write_text(json.dumps({"level": node["level"], "children": children}))
        return old

    old = {k: v for k, v in {**root, "top": split(root["top"])}.items() if k != "packs"}
    (tmp_path / "nodes" / f".{name}.json.crc").unlink()
    (tmp_path / "nodes" / f"{name}.json").write_text(json.dumps(old))
    before = PrefixLog(spark, str(tmp_path), bits=2, fan=1)
    before.write(resolve(orders(spark, made(rng, [40])), price_type=PRICE))
    assert before.read().count() == 33 and before.end()["seq"] == 40
