"""DataFrame operators over the canonical long layout (see :mod:`tsforge.spec`)."""
