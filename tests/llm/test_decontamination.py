from __future__ import annotations

import itertools
import random
import re

from helpers import DOC, ODD, documents, prose

from docketry.llm import decontamination as dc

ITEM = "item_id long, text string"


def words(text):
    return [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", (text or "").lower()) if w]


def expected(docs, items):
    """The best diagonal of all pairs that meet the rule, whether or not a seed hits."""
    out = {}
    for d, text in docs:
        a = words(text)
        for i, item in items:
            b = words(item)
            if b and min(len(a), len(b)) < 4 and a == b:
                out[d, i] = (len(b), len(b))
            if min(len(a), len(b)) < 4:
                continue
            for diagonal in range(1 - len(b), len(a)):
                pairs = [(k, k - diagonal) for k in range(max(0, diagonal), min(len(a), len(b) + diagonal))]
                same = [a[x] == b[y] for x, y in pairs]
                w = min(13, len(same))
                best = max(sum(same[s : s + w]) for s in range(len(same) - w + 1))
                if sum(same) == len(b) or len(b) >= 8 and ((len(same) >= 8 and 100 * best >= 80 * w) or 100 * sum(same) >= 60 * len(b)):
                    out[d, i] = max(out.get((d, i), (0, 0)), (sum(same), best))
    return out


def cases():
    rng = random.Random(3)
    items = [(k, prose(rng, n, 3000)) for k, n in enumerate([7, 8, 13, 25, 40, 60, 2, 5])] + [(20, None), (21, ""), (22, prose(rng, 25, 3000)), (None, prose(rng, 20, 3000)), (2, prose(rng, 18, 3000))]
    texts = list(ODD)
    for _, item in items:
        own = (item or "").split()
        for rate in (0, 0.1, 0.2, 0.5):
            changed = [w if rng.random() >= rate else "zz" for w in own]
            texts.append(prose(rng, 20, 3000) + " " + " ".join(changed).upper() + ", " + prose(rng, 15, 3000))
        texts += [" ".join(own[len(own) // 2 :]), " ".join(own), "Zz " + " ".join(own)]
    return texts, items


def test_all_pairs(spark, monkeypatch):
    texts, items = cases()
    bench = spark.createDataFrame(items, ITEM)
    want = expected(list(enumerate(texts)), items)
    assert len(want) > 15
    for limit in (dc.SMALL_SEEDS, 0):  # the broadcast look-up and the shuffled one
        monkeypatch.setattr(dc, "SMALL_SEEDS", limit)
        got = {(r.doc_id, r.item_id): (r.equal_tokens, r.best_window) for r in dc.overlaps(documents(spark, texts), bench).collect()}
        assert got == want


def test_two_substitutions_in_a_window_leave_a_seed():
    hits = lambda same: any(all(same[s + k] for k, bit in enumerate(m) if bit == "1") for m in dc.MASKS for s in range(len(same) - len(m) + 1))
    assert all(hits([k not in gone for k in range(13)]) for gone in itertools.combinations(range(13), 2))
    assert hits([k % 4 != 3 for k in range(13)]) and hits([True] * 4)


def test_recall_of_items_with_many_substitutions(spark):
    """Items of 16 to 60 tokens, a fifth to a third of them replaced; the expectation knows no masks."""
    rng = random.Random(11)
    items = [(k, prose(rng, n, 30_000)) for k, n in enumerate([16, 20, 30, 45, 60])]
    texts = []
    for _, item in items:
        for rate in (0.2, 0.3, 0.35):
            for _ in range(20):
                texts.append(f"{prose(rng, 10, 30_000)} {' '.join(w if rng.random() >= rate else f'z{rng.randrange(10**6)}' for w in item.split())} {prose(rng, 10, 30_000)}")
        texts.append(f"{prose(rng, 10, 30_000)} {' '.join(w if k % 4 != 3 else 'zz' for k, w in enumerate(item.split()))}")
    want = expected(list(enumerate(texts)), items)
    got = {(r.doc_id, r.item_id): (r.equal_tokens, r.best_window) for r in dc.overlaps(documents(spark, texts), spark.createDataFrame(items, ITEM)).collect()}
    assert got.items() <= want.items() and len(got) >= 0.97 * len(want) > 200
    for size in range(5):
        own = [k for k in want if k[1] == size]
        assert sum(k in got for k in own) >= 0.9 * len(own)
        assert (61 * size + 60, size) in got


def test_clean_rows_stay(spark):
    texts, items = cases()
    bench = spark.createDataFrame(items, ITEM).withColumnRenamed("text", "body")
    docs = documents(spark, texts).withColumnRenamed("lang", "t").withColumnRenamed("source", "item_id")
    docs = docs.unionByName(docs)
    kept = dc.keep_clean(docs, bench, item_text="body")
    assert kept.columns == docs.columns
    gone = {d for d, _ in expected(list(enumerate(texts)), items)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(2 * [i for i in range(len(texts)) if i not in gone])
    empty, none = spark.createDataFrame([], DOC), spark.createDataFrame([], ITEM)
    assert dc.overlaps(empty, spark.createDataFrame(items, ITEM)).collect() == []
    assert dc.keep_clean(docs, none).count() == docs.count()
