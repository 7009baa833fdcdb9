"""``python -m registry [sf_dir] [name ...]``: run queries beside their SQL."""

from __future__ import annotations

import sys

from tapflow.session import local_session

from .compare import check_all

if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    bad = check_all(local_session(), sf, args[1:])
    sys.exit(1 if bad else 0)
