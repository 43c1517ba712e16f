from __future__ import annotations

import hashlib
import random
import re

from helpers import DOC, documents, prose

from docketry.llm import pii_bootstrap as pb

#: The patterns as they are stated.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in STATED.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def told(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def card(rng):
    body = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


def noisy(rng):
    bits = ["a.b@c.d@e.f", "x@y", "@a.b", "a@b..c", "a@b.c-d.e_f@g.h", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "0001.02.3.255", "1.2.3", "9.9.9.9999999999999999999", "+1 (234) 555-0199", "+12", "++1 2345678 9", "+1234567890123456", "+1..........2", "日本é𝒳", "\n", " ", "-", ".", "x%y+z@mail.example.com", "4-4", "0" * 30]
    out = []
    for _ in range(rng.randrange(1, 30)):
        c = card(rng)
        out.append(rng.choice([*bits, c, " ".join(c[i : i + 4] for i in range(0, 16, 4)), "-".join(c[i : i + 4] for i in range(0, 16, 4)), c[:-1] + str((int(c[-1]) + 1) % 10), "".join(rng.choice("0123456789.+-@ ()a") for _ in range(rng.randrange(1, 40)))]))
        out.append(rng.choice(["", " ", " and "]))
    return "".join(out)


def test_fixed_patterns_match_their_wording(spark):
    rng = random.Random(7)
    texts = [None, "", *[noisy(rng) for _ in range(400)], " 1.2.3.4 a@b.cd," * 900]
    rows = pb.personal_data(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(told(want).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in pb.KINDS]
        spans = r.spans.split(",") if r.spans else []
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(spans) and len(spans) == len(want) + r.n_found
        order = [(pb.KINDS.index(x.split(":")[0]), int(x.split(":")[1])) for x in spans]
        assert order == sorted(order)


def test_contexts_find_what_the_patterns_miss(spark):
    rng = random.Random(3)
    texts, hidden = [], {}
    for i in range(12):
        texts.append(f"{prose(rng, 30)} please call me at +1 (555) 010-{2000 + i} {prose(rng, 9)} my mail address is user{i}@mail.example.com. {prose(rng, 9)} logged in from host 10.0.0.{i} {prose(rng, 9)}")
    for kind, lead, what in (("phone", "call me at", "555-010-7777"), ("email", "my mail address is", "root@localhost"), ("ip", "logged in from host", "10.0.0.777"), ("ip", "Logged in from HOST:", "fe80:0:0:0:1:2:3:4")):
        for tail in ("", " again"):
            text = f"{prose(rng, 20)} {lead} {what}{tail} {prose(rng, 5)}"
            hidden[len(texts)] = f"{kind}:{text.index(what)}:{text.index(what) + len(what)}"
            texts.append(text)
    text = f"{prose(rng, 20)} elsewhere root@localhost {prose(rng, 5)}"  # a discovered string without the context
    hidden[len(texts)] = f"email:{text.index('root@')}:{text.index('root@') + 14}"
    texts.append(text)
    clean = range(len(texts), len(texts) + 20)
    for i in clean:
        texts.append(f"{prose(rng, 20)} order number 555-{1000000 + i} of {rng.randrange(10**7, 10**8)} {prose(rng, 10)} 10:20:30:{40 + i}")
    rows = {r.doc_id: r for r in pb.personal_data(documents(spark, texts)).collect()}
    assert {i: rows[i].spans for i in hidden} == hidden
    assert all(rows[i].spans == "" and rows[i].n_found == 0 for i in clean)


def test_very_long_runs_end(spark):
    texts = ["a" * 400_000, "1" * 400_000, "1.1." * 100_000, "+1" + "(" * 200_000, "a@" * 100_000, "7 " * 200_000, "x" + "%" * 300_000 + "@"]
    rows = {r.doc_id: r for r in pb.personal_data(documents(spark, texts)).collect()}
    assert rows[0].spans == rows[1].spans == "" and rows[2].n_ip == 50_000


def test_repeats_null_ids_clashes_and_empty_tables(spark):
    rows = [(None, "a@b.cd", "x", "y", 1), (None, "a@b.cd", "x", "y", 1), (4, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOC).withColumnsRenamed({"lang": "rid", "source": "email", "n_chars": "spans"})
    assert sorted((r.doc_id or 0, r.spans) for r in pb.personal_data(docs).collect()) == [(0, "email:0:6"), (0, "email:0:6"), (4, "")]
    assert pb.personal_data(spark.createDataFrame([], DOC)).collect() == []
