"""Contact records, transcripts and cases: JSON to joined daily call tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators.cdc import newest_per_key
from docketry.operators.projections import day_and_day_before, rename_map

UTTERANCES = "array<struct<ParticipantId:string,Content:string,Sentiment:string>>"


def extract_map(df: DataFrame, keys: Mapping[str, Sequence[str]], json_col: str = "json_value") -> DataFrame:
    """``{column: [key1, key2]}`` to string columns; an empty key2 takes the whole value.

    The line is parsed once into a variant and read by path; broken lines give nulls.
    """
    def at(k1: str, k2: str) -> Column:
        path = f"$['{k1}']" + (f"['{k2}']" if k2 else "")
        return F.try_variant_get("_json", path, "string")

    parsed = df.withColumn("_json", F.try_parse_json(json_col))
    rest = [c for c in df.columns if c != json_col]
    return parsed.select(*rest, *[at(k1, k2).alias(name) for name, (k1, k2) in keys.items()])


def contact_latest(contacts: DataFrame, key: str = "Contact_ID", updated: str = "Last_Update_Time", *ties: str) -> DataFrame:
    """Newest record per contact; the update time itself is dropped."""
    return newest_per_key(contacts, [key], F.desc(updated), *[F.desc(t) for t in ties]).drop(updated)


def conversations(df: DataFrame, transcript: str = "trans_Transcript", into: str = "Conversations") -> DataFrame:
    """Utterance JSON to an array of {Caller_Type, Text, Sentiment}."""
    turns = F.transform(
        F.from_json(transcript, UTTERANCES),
        lambda u: F.struct(
            u["ParticipantId"].alias("Caller_Type"), u["Content"].alias("Text"), u["Sentiment"].alias("Sentiment")
        ),
    )
    return df.withColumn(into, turns).drop(transcript)


def transcripts(raw: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    return conversations(extract_map(raw, keys).distinct())


def case_latest(
    cases: DataFrame, day: dt.date | str, names: Mapping[str, str], key: str = "Id", created: str = "CreatedDate",
    modified: str = "LastModifiedDate", ties: Sequence[str] = (),
) -> DataFrame:
    """Cases created on the day or the day before, newest version of each, renamed, distinct."""
    recent = day_and_day_before(cases, created, day)
    newest = newest_per_key(recent, [key], F.desc(modified), *[F.desc(t) for t in ties])
    return (rename_map(newest, names) if names else newest).distinct()


def case_latest_range(
    cases: DataFrame, start: dt.date | str, end: dt.date | str, names: Mapping[str, str], day_col: str = "call_day",
    key: str = "Id", created: str = "CreatedDate", modified: str = "LastModifiedDate", ties: Sequence[str] = (),
) -> DataFrame:
    """case_latest for every day of a range in one job: a case counts for its day and the next."""
    lo, hi = (F.lit(str(d)).cast("date") for d in (start, end))
    at = F.col(created)
    recent = cases.filter((at >= F.date_sub(lo, 1)) & (at < F.date_add(hi, 1)))
    own = at.cast("date")
    per_day = recent.withColumn(day_col, F.explode(F.array(own, F.date_add(own, 1)))).filter(F.col(day_col).between(lo, hi))
    newest = newest_per_key(per_day, [day_col, key], F.desc(modified), *[F.desc(t) for t in ties])
    return rename_map(newest, {day_col: day_col, **names}).distinct()


def join_call_case(
    trans: DataFrame, contacts: DataFrame, cases: DataFrame, unit: str, contact_key: str = "Contact_ID",
    case_key: str = "SF_Case_ID", unit_col: str = "BU", on_day: str | None = None,
) -> DataFrame:
    """Transcripts with their contact record and case, for one business unit.

    The unit comes from the contact record, so the filter also runs before the joins and
    the left joins still keep transcripts of the unit without a case.
    """
    days = [on_day] if on_day else []
    with_contact = trans.join(contacts, [contact_key, *days], "left").filter(F.col(unit_col) == unit)
    return with_contact.join(cases, [case_key, *days], "left")


def dialogue_text(conversation: Column) -> Column:
    """'TYPE: text TYPE: text' of an utterance array."""
    return F.array_join(F.transform(conversation, lambda u: F.concat(u["Caller_Type"], F.lit(": "), u["Text"])), " ")


def dialogue_from_turns(
    turns: DataFrame, key: str, turn: str, role: str, text: str, into: str = "Dialogue_Text", chunk: int = 1000
) -> DataFrame:
    """Dialogue text from one row per turn.

    Turns are put in order within chunks first and the chunks of a conversation after that,
    so a very long conversation is spread over many tasks and its last step only joins
    ready pieces.
    """
    line = F.concat(F.col(role), F.lit(": "), F.col(text))
    ordered = lambda c: F.array_join(F.transform(F.sort_array(c), lambda p: p["line"]), " ")
    pieces = turns.groupBy(key, F.floor(F.col(turn) / chunk).alias("_chunk")).agg(
        ordered(F.collect_list(F.struct(F.col(turn).alias("at"), line.alias("line")))).alias("_piece")
    )
    return pieces.groupBy(key).agg(
        ordered(F.collect_list(F.struct(F.col("_chunk").alias("at"), F.col("_piece").alias("line")))).alias(into)
    )


def search_topics(df: DataFrame, text: str, topics: Mapping[str, Sequence[str]]) -> DataFrame:
    """One boolean column per topic: any of its patterns occurs in the text."""
    return df.withColumns(
        {f"topic_{name}": F.coalesce(F.col(text).rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False))
         for name, patterns in topics.items()}
    )
