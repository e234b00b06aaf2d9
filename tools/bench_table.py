"""

    python tools/bench_table.py sf0.1.json [sf0.01.json ...]
"""

import json
import sys


def main(paths):
    runs = [json.loads(open(p).read().strip().splitlines()[-1]) for p in paths]
    names = list(runs[0]["queries"])
    head = "| query | " + " | ".join(f"sf{r['sf']} (s)" for r in runs) + " |"
    print(head)
    print("| --- |" + " --- |" * len(runs))
    for n in names:
        print(f"| {n} | " + " | ".join(f"{r['queries'].get(n, float('nan')):.2f}" for r in runs) + " |")
    print("| **total (value)** | " + " | ".join(f"**{r['value']:.1f}**" for r in runs) + " |")
    print("| first runs, queries only (cold_total_sec) | " + " | ".join(f"{r.get('cold_total_sec', float('nan')):.1f}" for r in runs) + " |")


if __name__ == "__main__":
    main(sys.argv[1:])
