"""Small tables with awkward rows, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=0):
    rows = [(first + i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def classes(nodes, links):
    """Least node of each node's component."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            if label[a] != least or label[b] != least:
                label[a] = label[b] = least
                changed = True
    return label


ODD = [None, "", " \n\t", "one", "one", "One", "word " * 4000, "é×÷ 日本 <|endoftext|>", "a.b!c?d\n\n"]
