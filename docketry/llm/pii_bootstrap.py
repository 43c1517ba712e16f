"""Personal data by fixed patterns, and by contexts that those induce.

The fixed patterns give seeds. The words before a seed are lexical patterns; every identifier-like
string is an instance, and patterns and instances form a graph. Rounds alternate over it: a pattern is
trusted as far as its instances are known to be of one kind, an instance as far as its patterns are.
Instances that trusted patterns agree on are marked wherever they occur. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import bind
from docketry.session import stage

KINDS = ("email", "ip", "card", "phone")
# The kinds' patterns without backtracking. A local part or a number is tried at its start only: a later
# start in the same run of characters finds nothing that the first one doesn't, and \G lets a search go on
# in the middle of a run, after a match.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Strings that look like an identifier of some kind.
LOOSE = (
    r"(?<![\p{L}\p{N}._%+@-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}._-]*[\p{L}\p{N}]"
    r"|(?<![\p{L}\p{N}:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![\p{L}\p{N}:])"
    r"|(?<![\p{L}\p{N}])\(?[0-9][0-9\x20().:-]{5,}(?<=[0-9])(?![\p{L}\p{N}@])"
)
#: Longest string that counts as an instance beyond the fixed patterns, and how far a context reaches back.
LONGEST, REACH = 64, 64
#: A pattern needs so many known instances, pattern and instance so much trust; rounds over the graph.
SUPPORT, TRUST, ROUNDS = 3, 0.7, 4
_BLOCK = 64
_SPAN = "array<struct<s:int,e:int,m:string,g:string>>"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _matches(text: Column, pattern: str) -> Column:
    """All matches in order: start, end (code points, end exclusive), the match, and the end of what lies between it and the one before.

    Places are running sums of the lengths of matches and of the texts between them, in blocks, so that
    a text with very many matches stays affordable.
    """

    def placed(ms: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            def with_lengths(t: Column) -> Column:
                blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(t) - 1) / _BLOCK).cast("int")), lambda b: _sum(F.slice(t, b * _BLOCK + 1, F.lit(_BLOCK))))

                def with_blocks(before: Column) -> Column:
                    def one(m: Column, i: Column) -> Column:
                        block = F.floor(i / _BLOCK).cast("int")
                        end = F.get(before, block) + _sum(F.slice(t, block * _BLOCK + 1, i - block * _BLOCK + 1))
                        return F.struct((end - F.length(m)).alias("s"), end.alias("e"), m.alias("m"), F.right(F.get(gaps, i), F.lit(REACH)).alias("g"))

                    return F.transform(ms, one)

                return bind(bind(blocks, lambda b: F.transform(b, lambda _, k: _sum(F.slice(b, F.lit(1), k)))), with_blocks)

            return bind(F.transform(ms, lambda m, i: F.length(m) + F.length(F.get(gaps, i))), with_lengths)

        return bind(F.split(text, pattern, -1), with_gaps)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bind(found, lambda ms: F.when(F.size(ms) > 0, placed(ms)).otherwise(F.array().cast(_SPAN)))


def _parts_fit(m: Column) -> Column:
    def at_most_255(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return (F.length(digits) <= 3) & (F.lpad(digits, 3, "0") <= "255")

    return F.forall(F.split(m, r"\."), at_most_255)


def _digits(m: Column, others: str) -> Column:
    return F.translate(m, others, "")


_VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": _parts_fit,
    "card": lambda m: bind(_digits(m, " -"), lambda d: F.when(F.length(d).between(16, 19), F.call_function("luhn_check", d)).otherwise(False)),
    "phone": lambda m: F.length(_digits(m, "+ ().-")).between(8, 15),
}


def found_spans(docs: DataFrame) -> DataFrame:
    """`rid, doc_id`, the valid matches of each kind, and all identifier-like strings (`loose`) of the whole texts; null texts are empty.

    Written to the shared folder without the texts, one row per document, numbered by `rid`.
    """
    text = F.coalesce("text", F.lit(""))

    def fitting(kind: str) -> Column:
        return F.filter(_matches(text, PATTERNS[kind]), lambda x: _VALID[kind](x["m"]))

    columns = {kind: fitting(kind) for kind in KINDS}
    columns["email"] = F.when(F.contains(text, F.lit("@")), columns["email"]).otherwise(F.array().cast(_SPAN))
    columns["loose"] = F.filter(_matches(text, LOOSE), lambda x: F.length(x["m"]) <= LONGEST)
    return stage(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", *[c.alias(k) for k, c in columns.items()]), "spans")


def _overlaps(spans: Column, s: Column, e: Column) -> Column:
    """Whether one of some sorted, separate spans overlaps [s, e): the first that ends after s, by binary search."""
    start = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        before = F.get(spans, mid)["e"] <= s
        open_ = acc["lo"] < acc["hi"]
        return F.struct(F.when(open_ & before, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(open_ & ~before, mid).otherwise(acc["hi"]).alias("hi"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    return F.when(F.size(spans) > 0, F.coalesce(F.get(spans, F.aggregate(steps, start, halve)["lo"])["s"] < e, F.lit(False))).otherwise(False)


def _contexts(gap: Column) -> Column:
    """Lexical patterns before a string: the last two words, and the last one."""
    two = F.regexp_replace(F.regexp_extract(gap, r"(\p{L}+[^\p{L}\p{N}]+\p{L}+)[^\p{L}\p{N}]*\z", 1), r"[^\p{L}]+", " ")
    one = F.regexp_extract(gap, r"(\p{L}+)[^\p{L}\p{N}]*\z", 1)
    return F.filter(F.array(two, one), lambda p: p != "")


def occurrences(found: DataFrame) -> DataFrame:
    """`rid, kind, s, e, instance, patterns`: a row for each fixed match, and with a null kind for each loose one beside them."""

    def listed(column: str, kind: str | None) -> Column:
        spans = F.col(column)
        if kind is None:
            spans = F.filter(spans, lambda x: ~reduce(lambda a, b: a | b, [_overlaps(F.col(k), x["s"], x["e"]) for k in KINDS]))
        return F.transform(spans, lambda x: F.struct(F.lit(kind).cast("string").alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.lower(x["m"]).alias("instance"), F.lower(x["g"]).alias("g")))

    each = F.concat(*[listed(k, k) for k in KINDS], listed("loose", None))
    rows = found.select("rid", F.explode_outer(each).alias("x")).where("x is not null").select("rid", "x.*")
    return rows.withColumn("patterns", _contexts(F.col("g"))).drop("g")


def _fits(kind: str, i: Column) -> Column:
    """Whether a loose instance has the outline of a kind."""
    n = F.length(F.regexp_replace(i, "[^0-9]", ""))
    mail = F.contains(i, F.lit("@"))
    return {
        "email": mail,
        "ip": ~mail & i.rlike(r"\A[0-9a-f]{1,4}([.:][0-9a-f]{0,4}){3,7}\z"),
        "card": ~mail & ~i.rlike("[.:]") & n.between(12, 19),
        "phone": ~mail & ~F.contains(i, F.lit(":")) & n.between(7, 15),
    }[kind]


def bootstrap(seen: DataFrame, support: int = SUPPORT, trust: float = TRUST, rounds: int = ROUNDS) -> DataFrame:
    """`instance, kind, score` of the loose instances that trusted patterns agree on.

    A pattern's trust in a kind is the summed score of its known instances over the number of all its
    instances and one; an instance's score is a noisy-or over its trusted patterns. Fixed matches score 1.
    """
    pairs = seen.select("kind", "instance", F.explode_outer("patterns").alias("pattern")).where("pattern is not null")
    edges = stage(pairs.select("pattern", "instance").distinct(), "edges")
    seeds = stage(seen.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0)), "seeds")
    loose = stage(pairs.where("kind is null").select("pattern", "instance").distinct().join(seeds.select("instance"), "instance", "left_anti"), "loose")
    known, found, before = seeds, None, -1
    for _ in range(rounds):
        wide = known.groupBy("instance").agg(*[F.max(F.when(F.col("kind") == k, F.col("score"))).alias(k) for k in KINDS])
        stats = edges.join(wide, "instance", "left").groupBy("pattern").agg(F.count("*").alias("n"), *[F.coalesce(F.sum(k), F.lit(0.0)).alias(k) for k in KINDS])
        each = stats.select("pattern", "n", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("known")) for k in KINDS])).alias("x")).select("pattern", "x.*", (F.col("x.known") / (F.col("n") + 1)).alias("trust"))
        trusted = each.where((F.col("known") >= support) & (F.col("trust") >= trust))
        outline = reduce(lambda a, b: a | b, [(F.col("kind") == k) & _fits(k, F.col("instance")) for k in KINDS])
        met = loose.join(trusted, "pattern").where(outline).groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("score"))
        best = met.where(F.col("score") >= trust).groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b")).select("instance", "b.kind", "b.score")
        found = stage(best, "discovered")
        now = found.count()
        if now == before or not now:
            break
        before, known = now, seeds.unionByName(found)
    return found


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat(F.get(F.array(*map(F.lit, KINDS)), x["k"]), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """`doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found` per document.

    Counts and hash are those of the fixed patterns; `spans` also holds the `n_found` spans of discovered
    instances, in order of kind and start. Every row of the input is a row of the result, repeated or null
    ids included; null texts are empty. An empty table gives none.
    """
    found = found_spans(docs)
    seen = stage(occurrences(found), "occurrences")
    more = seen.where("kind is null").select("rid", "s", "e", "instance").join(bootstrap(seen).select("instance", "kind"), "instance")
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    added = more.select("rid", F.struct(place.alias("k"), "s", "e").alias("x")).groupBy("rid").agg(F.collect_list("x").alias("added"))

    def placed(k: int) -> Column:
        return F.transform(F.col(KINDS[k]), lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    base = F.concat(*map(placed, range(len(KINDS))))
    both = found.join(added, "rid", "left").withColumn("base", base).withColumn("added", F.coalesce("added", F.array().cast("array<struct<k:int,s:int,e:int>>")))
    return both.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(_told(F.col("base")), 256).alias("base_sha256"),
        _told(F.sort_array(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_found"),
    )
