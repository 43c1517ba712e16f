"""Words of a corpus with the words one code point away, found by pairs of trie nodes.

A forward trie of the words has a node for every prefix, a reversed one for every suffix. Each word
lists the pairs (prefix node, suffix node) around each of its code points and at each place between
them. Two words that share a pair around a code point differ in that code point alone; a word whose
place between two code points has the pair that another word has around one of its own is that word without it. So
equality of integer pairs gives exactly the words at distance one, without comparing texts.

A node's number is a 64-bit fingerprint of its path, the same in every task; a second, independent
fingerprint of both paths is compared with the pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.text_batches import ByteSums, mix, signed, text_bytes
from docketry.llm.workers import map_arrow
from docketry.session import stage

#: Letters of a word, as the inside of a character class.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of so many code points, that occur so often, and how much more frequent a word's form is.
LENGTH, OCCURRENCES, TIMES = 6, 5, 5
#: Words of one step, in bytes.
STEP = 1 << 17
_ODD = np.uint64(0x9E3779B97F4A7C15)


def dictionary(docs: DataFrame, one_in: int = 199, length: int = LENGTH, occurrences: int = OCCURRENCES) -> DataFrame:
    """`word, n`: runs of letters with A-Z lowered, at least so long and so frequent in the whole texts.

    One in `one_in` runs, by a hash of document and run, loses a code point. A null document number
    counts as an empty text there, a null text has no words.
    """
    # Only runs that are long enough come out: a shorter one matches at none of its places.
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[{LETTERS}]{{{length},}}+"), F.lit(0))
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("w"))
    hashed = each.select("w", F.crc32(F.concat("d", F.lit(":"), "w").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("w")).cast("int")
    lost = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))
    word = F.when(F.col("h") % one_in == 0, lost).otherwise(F.col("w"))
    counted = hashed.select(word.alias("word")).where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= occurrences)


def _node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word and place: nodes before and after it; kind 0 between code points, 1 around one, 2 around the last of equal ones in a row."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("word"))
        ids, counts = (np.asarray(batch.column(c)) for c in ("id", "n"))
        row = 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STEP, "right")) - 1)
            piece, ends = data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
            nodes, check = ByteSums(piece), ByteSums(piece, second=True)
            at = np.flatnonzero((piece & 0xC0) != 0x80)
            after = np.append(at[1:], len(piece))
            word = np.searchsorted(ends, at, "right") - 1
            point = nodes.of(at, after)
            last = np.ones(len(at), bool)
            last[:-1] = (point[1:] != point[:-1]) | (word[1:] != word[:-1])
            whole = np.arange(to - row)
            w = np.concatenate([word, word, whole])
            left = np.concatenate([at, at, ends[1:]])  # where the prefix ends
            right = np.concatenate([after, at, ends[1:]])  # where the suffix starts
            kind = np.concatenate([np.where(last, 2, 1), np.zeros(len(at) + len(whole), np.int64)]).astype(np.int8)
            first, end = ends[:-1][w], ends[1:][w]
            second = mix(check.of(first, left)) * _ODD + check.of(right, end)
            columns = [signed(nodes.of(first, left)), signed(nodes.of(right, end)), signed(second), kind, counts[row:to][w], ids[row:to][w]]
            for k in range(0, len(w), STEP):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + STEP]) for c in columns], ["prefix", "suffix", "second", "kind", "n", "id"])
            row = to


#: Two members of a pair are near if each lists it around a code point, or one around its last of equal ones and the other between two.
_NEAR = """filter(transform(m, x -> named_struct('id', x.id, 'near', filter(m, y -> y.id <> x.id and
 (x.kind > 0 and y.kind > 0 or x.kind + y.kind = 2 and x.kind <> y.kind)))), x -> size(x.near) > 0)"""


def neighbours(words: DataFrame) -> DataFrame:
    """`id, n_near, best`: for words (`id` in the order of `word`, `n`) with near words, how many, and the most frequent as (n, -id).

    A pair's group holds at most one word between its nodes and one for each letter, however many words there are.
    """
    pairs = map_arrow(words.select("id", "n", "word"), _node_pairs, "prefix long, suffix long, second long, kind byte, n long, id long")
    groups = pairs.groupBy("prefix", "suffix", "second").agg(F.collect_list(F.struct("kind", "n", "id")).alias("m")).where("size(m) > 1")
    near = groups.select(F.explode(F.expr(_NEAR)).alias("x"))
    best = F.expr("array_max(transform(x.near, y -> named_struct('n', y.n, 'back', -y.id)))")
    return near.select("x.id", F.size("x.near").cast("long").alias("k"), best.alias("b")).groupBy("id").agg(F.sum("k").alias("n_near"), F.max("b").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """`id, root` for `id, form`: the last word that following forms leads to.

    Each round doubles the steps. A form is several times as frequent as its word, so a chain is as long as a logarithm of the largest count.
    """
    now = forms.select("id", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        now = stage(now.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for every word of the dictionary.

    The form is the near word of the largest count (ties: least in code-point order) if that is at
    least TIMES the word's own, else null; the root is where forms lead to, the word itself without
    one. Repeated documents count as often as they come. No words give an empty table.
    """
    # Ranges sorted by word and numbered in order: ids compare as the words do.
    ordered = stage(dictionary(docs), "counts").repartitionByRange("word").sortWithinPartitions("word")
    words = stage(ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "dictionary")
    near = neighbours(words)
    joined = words.select("id", "n").join(near, "id", "left")
    form = F.when(F.col("best.n") >= TIMES * F.col("n"), F.struct((-F.col("best.back")).alias("form"), F.col("best.n").alias("form_n")))
    found = stage(joined.select("id", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("f")).select("id", "n_near", "f.form", "f.form_n"), "forms")
    ends = roots(found.where("form is not null"))
    names = lambda c: words.select(F.col("id").alias(f"{c}_id"), F.col("word").alias(c))
    linked = found.where("form is not null").join(ends, "id").withColumnsRenamed({"form": "form_id", "root": "root_id"})
    named = linked.join(names("form"), "form_id").join(names("root"), "root_id").select("id", "form", "root")
    full = words.join(found.select("id", "n_near", "form_n"), "id").join(named, "id", "left")
    return full.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
