"""Print the SURVEY §2 ID → registered query table (markdown) from the registry."""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retention_engine.plans.registry import load_all  # noqa: E402


def key(o: str):
    m = re.match(r"([A-Z]+)-?([A-Z]?)(\d*)", o)
    return (m.group(1), m.group(2), int(m.group(3) or 0))


def main():
    reg = load_all()
    by_op: dict[str, list[str]] = {}
    for n, q in reg.items():
        for o in q.ops:
            by_op.setdefault(o, []).append(f"`{n}`" + ("" if q.sql else " (rows)"))
    print(f"Registered queries: {len(reg)}; with a SQL oracle: {sum(1 for q in reg.values() if q.sql)}.\n")
    print("| ID | registered queries ((rows) = no SQL oracle) |\n|---|---|")
    for o in sorted(by_op, key=key):
        print(f"| {o} | {', '.join(by_op[o])} |")


if __name__ == "__main__":
    main()
