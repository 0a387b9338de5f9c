"""Reading JSON records and splitting off what cannot be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillmart import codes
from rillmart.functions import jsontext as js
from rillmart.schemas import APP_LOG, CHANGE, CONFIG_CHANGE, LOG_TEXT

_CORRUPT = "_corrupt"


def parse_json(
    raw: DataFrame, schema: T.StructType, value: str = "value", keep: list[str] | None = None
) -> DataFrame:
    """Parse a JSON string column into ``rec`` (null when malformed) next to ``value``.

    Every job parses once, right after the source, so later operators see typed
    columns only. Empty payloads, ``null`` and non-objects count as malformed.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(value),
        with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    looks_like_object = F.col(value).rlike(r"^\s*\{")
    # Exploding a one-element array keeps the optimizer from copying the parse into
    # every filter and column that uses its result: each text is parsed once.
    df = raw.select(*(keep or []), F.col(value), F.explode(F.array(parsed)).alias("rec"))
    ok = looks_like_object & F.col("rec").isNotNull() & F.col(f"rec.{_CORRUPT}").isNull()
    names = [F.col(f"rec.{n}") for n in schema.names]
    return df.select(
        *(keep or []), value, F.when(ok, F.struct(*names)).alias("rec")
    )


def split_dirty(
    parsed: DataFrame, usable: Column, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(good, dirty): rows whose record parsed and is usable, and the others.

    ``usable`` is evaluated on ``rec``; null counts as not usable. Good rows lose
    the raw text, dirty rows keep nothing else, so each side reads what it needs.
    """
    verdict = F.coalesce(F.col("rec").isNotNull() & usable, F.lit(False))
    good = parsed.where(verdict).drop(value)
    dirty = parsed.where(~verdict).drop("rec")
    return good, dirty


def parse_app_log(raw: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Application logs; a record without a device id cannot be keyed and is dirty."""
    parsed = parse_json(raw, APP_LOG, keep=keep)
    good, dirty = split_dirty(parsed, F.col("rec.common.mid").isNotNull())
    return good.select(*(keep or []), "rec.*"), dirty


def parse_log_text(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Application logs with their objects as JSON text, for the log split.

    Adds ``mid`` and ``is_new``, the record's members of other names as text in ``rest``,
    and the whole text of a record that is dirty in ``bad`` (empty for none). A record is dirty too whose
    page, start or array items are no objects: no topic could take them.
    """
    parsed = parse_json(raw, LOG_TEXT, keep=keep)
    fields = {n: F.col(f"rec.{n}") for n in LOG_TEXT.names}
    mid = F.get_json_object(fields["common"], "$.mid")

    def all_objects(texts: Column) -> Column:
        return F.forall(texts, lambda i: F.coalesce(js.is_object(i), F.lit(False)))

    shapes = [js.is_object(fields[n]) for n in ("page", "start")]
    shapes += [all_objects(fields[n]) for n in ("actions", "displays")]
    usable = F.coalesce(mid.isNotNull(), F.lit(False))
    for shape in shapes:
        usable = usable & F.coalesce(shape, F.lit(True))
    judged = parsed.withColumn("ok", usable)
    ok = F.col("ok")
    return judged.select(
        *(keep or []),
        F.when(~ok, F.coalesce("value", F.lit(""))).alias("bad"),
        F.when(ok, mid).alias("mid"),
        F.when(ok, F.get_json_object(fields["common"], "$.is_new")).alias("is_new"),
        *[F.when(ok, field).alias(n) for n, field in fields.items()],
        F.when(ok, js.others(F.col("value"), *LOG_TEXT.names)).alias("rest"),
    )


def parse_changes(raw: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Change records; snapshot markers carry no row and count as dirty."""
    parsed = parse_json(raw, CHANGE, keep=keep)
    usable = ~F.coalesce(F.col("rec.type"), F.lit("")).isin(*codes.BOOTSTRAP_MARKERS)
    good, dirty = split_dirty(parsed, usable)
    return good.select(*(keep or []), "rec.*"), dirty


def parse_changes_whole(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Both at once: typed columns, and in ``bad`` the text of a record that is dirty."""
    parsed = parse_json(raw, CHANGE, keep=keep)
    usable = F.coalesce(
        F.col("rec").isNotNull()
        & ~F.coalesce(F.col("rec.type"), F.lit("")).isin(*codes.BOOTSTRAP_MARKERS),
        F.lit(False),
    )
    return parsed.select(
        *(keep or []),
        F.when(~usable, F.col("value")).alias("bad"),
        *[F.when(usable, F.col(f"rec.{n}")).alias(n) for n in CHANGE.names],
    )


def parse_config(raw: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Change envelopes of the dimension configuration."""
    parsed = parse_json(raw, CONFIG_CHANGE, keep=keep)
    good, dirty = split_dirty(parsed, F.col("rec.op").isNotNull())
    return good.select(*(keep or []), "rec.*"), dirty


def to_json_records(df: DataFrame) -> DataFrame:
    """One JSON string per row, for topics."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
