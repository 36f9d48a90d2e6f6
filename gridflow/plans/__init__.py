"""Jobs composed from the transforms, and the registered queries."""
