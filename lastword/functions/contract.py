"""The contract event: identity, validation, and its strict JSON form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lastword import model, settings as S
from lastword.functions import instants
from lastword.functions.keys import padded

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
NOT_ONE_EVENT = "line: not one event and nothing else"


def full_match(text: Column, pattern: str) -> Column:
    """Whole-text match; `rlike` alone only searches."""
    return text.rlike(rf"\A(?:{pattern})\z")


def not_blank(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\P{javaWhitespace}"), F.lit(False))


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def first_reason(rules: list[tuple[Column, str | Column]]) -> Column:
    """Reason of the first rule that does not hold, null when all hold."""
    checks = [F.when(~_holds(ok), reason if isinstance(reason, Column) else F.lit(reason))
              for ok, reason in rules]
    return F.coalesce(*checks)


def event_identity(entity_type: Column, entity_id: Column, revision: Column,
                   event_type: Column) -> Column:
    """Digest of one revision of one entity; a redelivery keeps it."""
    return F.sha2(F.concat_ws("\n", entity_type, entity_id, revision, event_type), 256)


def is_collection(entity_type: Column) -> Column:
    return entity_type.isin(*S.COLLECTIONS)


def lifecycle_reason(event: dict[str, Column], record_id: Column | None = None,
                     marker_id: Column | None = None) -> Column:
    """The checks that tie type, id, operation, revision and state together.

    A caller that has already matched the parts of the id passes what it found.
    """
    kind, ident, op = event["entity_type"], event["entity_id"], event["event_type"]
    if record_id is None:
        record_id = full_match(ident, f"{S.DID_PATTERN}/{S.RECORD_KEY_PATTERN}")
    if marker_id is None:
        marker_id = full_match(ident, S.DID_PATTERN)
    record = first_reason([
        (record_id, "record id: account and key expected"),
        (op.isin(*S.OPERATIONS), "operation: none of the three known ones"),
        (event["state"] == F.when(op == "delete", F.lit("deleted")).otherwise(F.lit("active")),
         "state: does not fit the operation"),
        (full_match(event["revision"], S.TID_PATTERN), "revision: not a record revision"),
    ])
    marker = first_reason([
        (kind.isin(S.ACCOUNT, S.SYNC),
         "type: neither a known collection nor a marker"),
        (kind == op, "marker: operation and type differ"),
        (marker_id, "marker id: account expected"),
        (event["revision"] == padded(event["source_seq"]),
         "marker revision: not the padded sequence"),
        ((kind != S.SYNC) | (event["state"] == "resynced"), "resync marker: wrong state"),
        (event["subject"].isNull(), "marker: subject not allowed"),
    ])
    return F.when(is_collection(kind), record).otherwise(marker)


def reason(event: dict[str, Column]) -> Column:
    """Why an event breaks the contract, null when it is valid."""
    filled = F.lit(True)
    for name in ("event_id", "source", "entity_type", "entity_id", "event_type", "revision",
                 "event_time", "received_at", "state"):
        filled = filled & not_blank(event[name])
    return F.coalesce(
        first_reason([
            (event["schema_version"] == S.SCHEMA_VERSION,
             f"version: not {S.SCHEMA_VERSION}"),
            (filled, "a required field is blank"),
            (full_match(event["event_id"], S.EVENT_ID_PATTERN),
             "event id: not a digest in lower-case hex"),
            (event["source_seq"] >= 0, "sequence: not a whole number from 0"),
        ]),
        lifecycle_reason(event),
        first_reason([
            (instants.is_instant(event["event_time"]), "event time: unreadable"),
            (instants.is_instant(event["received_at"]), "receive time: unreadable"),
        ]))


def columns(prefix: str = "") -> dict[str, Column]:
    return {name: F.col(prefix + name) for name in model.EVENT_FIELDS}


def event_json(prefix: str = "") -> Column:
    """Contract print: fields in declaration order, a missing subject kept as null."""
    return F.to_json(F.struct(*[column.alias(name) for name, column in columns(prefix).items()]),
                     {"ignoreNullFields": "false"})


def parse_lines(rows: DataFrame, line: str = "value") -> DataFrame:
    """Adds the event fields of one contract line per row, and `reason` when it is no valid event.

    Trailing text, unknown fields and fractions are errors. The JSON reader stops at the end of
    the first value, so the line is read inside an array and inside an object: text that closes
    one of the two too early is an error in the other.
    """
    one, text = model.EVENT.simpleString(), F.col(line)
    known = F.array(*map(F.lit, model.EVENT_FIELDS))
    read = rows.withColumns({
        "_inside": F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{one}>", _STRICT),
        "_wrapped": F.from_json(F.concat(F.lit('{"w":'), text, F.lit("}")), f"struct<w:{one}>",
                                _STRICT).getField("w").isNotNull(),
        "_unknown": F.size(F.array_except(F.json_object_keys(text), known))})
    event = F.try_element_at(F.col("_inside"), F.lit(1))
    whole = ((F.size("_inside") == 1) & F.col("_wrapped") & event.isNotNull()
             & (F.col("_unknown") == 0))
    fields = read.withColumns({"_whole": _holds(whole),
                               **{name: event[name] for name in model.EVENT_FIELDS}})
    why = F.when(~F.col("_whole"), F.lit(NOT_ONE_EVENT)).otherwise(reason(columns()))
    return sealed(fields.withColumn("reason", why)).drop("_inside", "_wrapped", "_unknown", "_whole")


def sealed(rows: DataFrame) -> DataFrame:
    """Keeps later filters above the computed columns of `rows`.

    A filter on a computed column is pushed below its projection with a copy of the expression,
    which for a JSON parse doubles the work. Below a row mark, which has no fixed value, it cannot
    be pushed. A stream takes no such mark; there a generator stands in between.
    """
    if rows.isStreaming:
        return rows.select(F.inline(F.array(F.struct(*[F.col(name) for name in rows.columns]))))
    marked = rows.withColumn("_mark", F.monotonically_increasing_id())
    return marked.filter(F.col("_mark") >= 0).drop("_mark")
