import re

from tidegate.llm.licences import TEMPLATES, THRESHOLD, find_licences


def pairs(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    return set(zip(w, w[1:]))


def brute(text):
    text = text or ""
    segments = set(text.split("\n")) | {p for p in re.split(r"\n\s*\n", text) if "\n" in p} | {text}
    found, best = set(), 0.0
    for segment in segments:
        a = pairs(segment)
        for licence, template in TEMPLATES:
            b = pairs(template)
            if a and (dice := 2 * len(a & b) / (len(a) + len(b))) >= THRESHOLD:
                found.add(licence)
                best = max(best, dice)
    return sorted(found), best


LONG = TEMPLATES[1][1]
TEXTS = [
    "prose\nLicensed under the Apache License, Version 2.0.\nmore prose",
    "LICENSED UNDER CC BY-NC 4.0", "licensed under something else entirely, version 2",
    "intro\n\n" + LONG.replace(" You may", "\nYou may").replace(" Unless", "\nUnless") + "\n\nend", LONG.replace("express", "stated"),
    "Released under the MIT License.\nThis work is licensed under the GNU General Public License, version 3.",
    "", None, "word", "\n\n\n", "Licensed under the Apache License, Version 2.0.\n" * 40, "x " * 5000,
]


def test_against_brute_force(docs):
    rows = find_licences(docs(TEXTS)).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        assert (row["licences"], row["best_dice"]) == brute(TEXTS[row["doc_id"]]), row["doc_id"]


def test_repeated_rows_and_empty_table(docs):
    twice = docs(TEXTS[:2]).unionByName(docs(TEXTS[:2]))
    assert [len(r["licences"]) for r in find_licences(twice).collect()] == [1] * 4
    assert find_licences(docs([])).collect() == []
