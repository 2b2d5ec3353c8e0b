"""Write INVENTORY.md: every registered key, its section, builder and check.

    python tools/inventory.py
"""

from __future__ import annotations

import inspect
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def operators_used(fn) -> str:
    """Operator calls in the builder's source, e.g. ``D.success_by_category``."""
    try:
        src = inspect.getsource(fn)
    except (OSError, TypeError):
        return ""
    calls = re.findall(r"\b(?:D|K|E|P|SM|FT|M|EV|IO|C)\.([a-z_]+)\(", src)
    helpers = [h for h in re.findall(r"\b(_?[a-z][a-z_]*)\(spark\b", src) if h not in ("def",)]
    names = [c for c in calls] + [h for h in helpers if h != fn.__name__]
    return ", ".join(dict.fromkeys(names))


def main():
    from fundlens.plans.registry import load_all

    specs = load_all()
    lines = ["# Query inventory", "",
             "Generated by `tools/inventory.py` from the registry behind `__spark_entry__.queries()`. "
             "Check `E` = exact DuckDB oracle in `oracle_sql()`; `R` = rows-only in the driver, invariants in "
             "`tests/`.", "",
             f"{len(specs)} keys, {sum(1 for s in specs.values() if s.sql)} with an exact oracle.", "",
             "| key | section | check | builder | operators used |", "| --- | --- | --- | --- | --- |"]
    for key in sorted(specs, key=lambda k: (specs[k].section, k)):
        s = specs[key]
        mod = s.build.__module__.replace("fundlens.", "")
        lines.append(f"| `{key}` | {s.section} | {s.check} | `{mod}` | {operators_used(s.build)} |")
    with open(os.path.join(ROOT, "INVENTORY.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
