"""Small generated sources with known truth."""

from __future__ import annotations

import csv
import os

FIRST = ["Amber", "Cedar", "Harbour", "Juniper", "Lantern", "Meadow", "Orchid", "Quartz", "Saffron", "Willow"]
SECOND = ["Bakers", "Drapers", "Foundry", "Glaziers", "Joinery", "Millers", "Nursery", "Printers", "Tannery"]
STREETS = ["Elm", "Ferry", "Granary", "Kiln", "Market", "Pier", "Thistle"]
LANDS = {"train": ["Kenya", "Peru"], "test": ["Norway", "Peru", "Kenya", ""]}


def without_address(i: int) -> bool:
    return i % 5 == 2


def alone(i: int) -> bool:
    return i % 9 == 4


def records_of(n: int, split: str) -> tuple[dict[int, list[tuple]], list[tuple]]:
    """Rows of three sources and the truth.  Source 2 shouts, marks names and lacks some addresses; source
    3 stutters legal words and hashes addresses; some records of source 1 have no match though they look
    alike."""
    rows: dict[int, list[tuple]] = {1: [], 2: [], 3: []}
    truth = []
    for i in range(n):
        name, house = f"{FIRST[i % 10]} {SECOND[i // 3 % 9]} Trading House {i}", f"{3 * i + 5} {STREETS[i % 7]}"
        land = LANDS[split][i % len(LANDS[split])]
        rows[1].append((f"S1-{i}", name, f"{house} Road", land))
        rows[2].append((f"S2-{i}", f"** {name.upper()}" if i % 2 else name, "<null>" if without_address(i) else f"{house} Rd.", land))
        rows[3].append((f"S3-{i}", f"{name} Ltd ltd" if i % 4 == 1 else name, f"## {house} Road" if i % 3 == 0 else f"{house} Road", land))
        truth.append((f"S1-{i}", "" if alone(i) else f"S2-{i},S3-{i}"))
    return rows, truth


def write_tsv(path: str, header: list[str], rows: list[tuple]) -> None:
    with open(path, "w", encoding="utf-8", newline="") as f:
        csv.writer(f, delimiter="\t", lineterminator="\n").writerows([header, *rows])


def write_sources(folder: str, split: str, n: int) -> str:
    os.makedirs(folder, exist_ok=True)
    sources, truth = records_of(n, split)
    for s, rows in sources.items():
        write_tsv(f"{folder}/{split}_source{s}.tsv", ["entity_id", "business_name", "business_address", "country"], rows)
    write_tsv(f"{folder}/{split}_ground_truth.tsv", ["source1_entity_id", "matched_entity_ids"], truth)
    return folder
