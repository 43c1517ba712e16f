from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from helpers import DOC, documents

from docketry.llm import spelling_tries as st


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts(docs):
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def expected(docs):
    words = counts(docs)
    nears = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(nears[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    rows = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, words[w], len(nears[w]), words[form[w]] if form[w] else None))
    return sorted(rows)


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def corpus():
    rng = random.Random(12)
    base = ["letters", "lettters", "banana", "bananna", "aaaaaa", "aaaaaaa", "aaaaaaaa", "Étéééé", "étéééé", "ÿÿÿÿÿÿÿ", "chained", "chaines", "chainés", "chaînés", "mississippi", "misissippi", "shorter", "short", "a" * 3000, "a" * 3001]
    base += ["".join(rng.choice("abé") for _ in range(rng.choice([6, 6, 7]))) for _ in range(60)]
    weights = [5 ** rng.randrange(0, 5) for _ in base]
    texts = []
    for k in range(260):
        words = rng.choices(base, weights, k=60) + base[k % len(base) :][:2]
        texts.append(" ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words) + rng.choice(["", "×÷×÷×÷", "1abcdef2abcdef", "日本abcdef"]))
    chain = " ".join(["orchard"] * 7 + ["orchards"] * 50 + ["orchardsy"] * 400)
    return [None, "", "x", chain, *texts]


def test_matches_all_pairs(spark):
    texts = corpus()
    want = expected(list(enumerate(texts)))
    assert sum(r[1] is not None for r in want) > 10 and any(r[2] not in (r[0], r[1]) for r in want)
    assert got(st.variants(documents(spark, texts))) == want


def test_every_place_of_a_word(spark):
    rng = random.Random(2)
    words = {"abcabca"}
    for w in ["abcabca", "aabbccdd", "ôaôaôaôa"]:
        words.add(w)
        for i in range(len(w) + 1):
            words |= {w[:i] + c + w[i:] for c in "abô"} | {w[:i] + c + w[i + 1 :] for c in "abô" if i < len(w)} | {w[:i] + w[i + 1 :]}
    words = sorted(words)
    df = spark.createDataFrame([(i, w, rng.randrange(1, 9)) for i, w in enumerate(words)], "id long, word string, n long")
    rows = {r.id: (r.n_near, r.best.n, -r.best.back) for r in st.neighbours(df).collect()}
    n = {r.id: r.n for r in df.collect()}
    for i, w in enumerate(words):
        nears = [k for k, v in enumerate(words) if near(w, v)]
        best = min(nears, key=lambda k: (-n[k], k), default=None)
        assert rows.get(i) == ((len(nears), n[best], best) if nears else None), w


def test_repeats_null_ids_clashes_and_empty_tables(spark):
    rows = [(None, "lettera letterb", "", "", 0), (7, "lettera", "", "", 0)] * 4 + [(8, "letterb letterb letterb letterb letterb", "", "", 0)] * 5
    docs = spark.createDataFrame(rows, DOC).withColumnsRenamed({"lang": "word", "source": "n"})
    assert got(st.variants(docs)) == expected([r[:2] for r in rows])
    assert st.variants(spark.createDataFrame([], DOC)).collect() == []
