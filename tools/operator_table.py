"""Print which registered queries exercise each operator id of the survey, as a Markdown table."""

from __future__ import annotations

import pathlib
import sys

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

SIZES = {"S": 17, "P": 19, "F": 11, "Q": 16, "A": 28, "W": 14, "O": 4, "X": 7, "C": 14, "T": 15, "G": 13, "M": 23, "E": 15}


def covered() -> dict[str, list[str]]:
    from larkspur.catalog import ENTRIES

    table: dict[str, list[str]] = {f"{letter}{i}": [] for letter, n in SIZES.items() for i in range(1, n + 1)}
    for name, entry in ENTRIES.items():
        for operator in entry.covers:
            table[operator].append(name + ("" if entry.sql else " (rows)"))
    return table


if __name__ == "__main__":
    print("| Operator | Queries |\n| --- | --- |")
    for operator, names in covered().items():
        print(f"| {operator} | {', '.join(f'`{n}`' if ' ' not in n else f'`{n.split()[0]}` (rows)' for n in names) or 'none'} |")
