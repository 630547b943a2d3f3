"""Plain, slow versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TRICKY = [
    None, "", " \n\t ", "one", "a b\nc d\n a b\nc d\n", "x\n\nx\n", "ä ö ü é x " * 30, "a " * 200,
    "\x1c\x85 \x0b\x0c\r\n\x00 end", "The quick. THE QUICK. the quick. " * 12, "😀 " * 25 + "\n" + "😀 " * 25,
    "\n", "w" * 5000, " ".join(f"w{i}" for i in range(3000)),
]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def quality(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams: dict = {}
    for i in range(len(w) - 7):
        grams.setdefault(tuple(w[i : i + 8]), []).append(i)
    marked = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


def repeats(rows: list[tuple[int, str | None]], k: int = 20) -> dict[int, tuple[int, int, str]]:
    """doc_id -> words, removed words, hash of the kept words; ids must be distinct."""
    seen: set = set()
    out = {}
    for doc_id, text in sorted(rows):
        w = words(text)
        gone = set()
        for i in range(len(w) - k + 1):
            gram = tuple(w[i : i + k])
            if gram in seen:
                gone.update(range(i, i + k))
            seen.add(gram)
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc_id] = (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out
