"""Row shaping: row events -> envelopes -> JSON.

A row event carries its images in log order in ``rows`` (array of structs).
Insert images become ``after``, delete images ``before``; update images come
in pairs (even = before, odd = after).  All of it is projection and
``posexplode`` -- no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.position import position_label
from ..model import DELETE_CODES, QUERY_CODE, UPDATE_CODES, WRITE_CODES


def operation_name(type_code) -> Column:
    """H5: insert / update / delete / query, otherwise the code as text."""
    c = F.col(type_code) if isinstance(type_code, str) else type_code
    return (F.when(c.isin(*WRITE_CODES), "insert").when(c.isin(*UPDATE_CODES), "update")
             .when(c.isin(*DELETE_CODES), "delete").when(c == QUERY_CODE, "query")
             .otherwise(c.cast("string")))


def event_seconds(ts) -> Column:
    """Header seconds of an event time given as a UTC wall clock (``timestamp_ntz``).

    A difference of two wall-clock values, so the session time zone never enters.
    """
    from ..functions.decode import epoch_ntz
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", epoch_ntz(), c)


def flatten_inserts(events: DataFrame, keep=("l_orderkey", "chunk")) -> DataFrame:
    """One record per image of a multi-row insert, image as ``after``."""
    return (events.filter(F.col("op") == "insert")
                  .select(*keep, F.posexplode("rows").alias("image_no", "after")))


def flatten_deletes(events: DataFrame, keep=("l_orderkey", "chunk")) -> DataFrame:
    """R2: one record per image of a multi-row delete, image as ``before``."""
    return (events.filter(F.col("op") == "delete")
                  .select(*keep, F.posexplode("rows").alias("image_no", "before")))


def pair_updates(events: DataFrame, keep=("l_orderkey", "chunk")) -> DataFrame:
    """Pair update images (even = before, odd = after).

    An odd image count leaves a tail with no ``after``; it is kept and marked
    ``odd_tail`` (the quarantine reads it), never dropped.
    """
    n = F.size("rows")
    pairs = F.when(n > 0, F.transform(
        F.sequence(F.lit(0), F.ceil(n / 2).cast("int") - 1),
        lambda k: F.struct(F.try_element_at("rows", k * 2 + 1).alias("before"),
                           F.try_element_at("rows", k * 2 + 2).alias("after"))))
    return (events.filter(F.col("op") == "update")
                  .select(*keep, F.posexplode(pairs).alias("pair_no", "p"))
                  .select(*keep, "pair_no", "p.before", "p.after",
                          F.when(F.col("p.after").isNull(), "odd_tail").otherwise("paired").alias("status")))


def pair_update_rows(images: DataFrame, event_keys=("l_orderkey",)) -> DataFrame:
    """R3 on the long form (one row per image, ``row_no`` from 0).

    Groups of (event, row_no div 2) hold at most two rows, so the aggregate is
    bounded whatever the event size; partial aggregation does the rest.
    """
    img_cols = [c for c in images.columns if c not in (*event_keys, "op")]
    img = F.struct(*img_cols)
    return (images.filter(F.col("op") == "update")
                  .groupBy(*event_keys, (F.col("row_no") / 2).cast("long").alias("pair_no"))
                  .agg(F.max(F.when(F.col("row_no") % 2 == 0, img)).alias("before"),
                       F.max(F.when(F.col("row_no") % 2 == 1, img)).alias("after"))
                  .withColumn("status", F.when(F.col("after").isNull(), "odd_tail").otherwise("paired")))


def event_changes(events: DataFrame, op: str = "event_type", rows: str = "rows") -> DataFrame:
    """R1-R3 for whatever table: one change per image (insert, delete) or image pair (update).

    Adds ``row_no`` (place within the event, so ``(file, position, row_no)`` names a
    change), ``before`` and ``after``; all other columns but ``rows`` stay.  An odd last
    update image has no ``after``; a query keeps one change without images.
    """
    r, kind = F.col(rows), F.col(op)
    none = F.lit(None).cast(events.schema[rows].dataType.elementType)
    n = F.size(r)
    pairs = F.transform(F.sequence(F.lit(0), F.ceil(n / 2).cast("int") - 1), lambda k: F.struct(
        F.get(r, k * 2).alias("before"), F.get(r, k * 2 + 1).alias("after")))
    changes = (F.when(kind == "query", F.array(F.struct(none.alias("before"), none.alias("after"))))
                .when(n <= 0, None)
                .when(kind == "insert", F.transform(r, lambda x: F.struct(none.alias("before"), x.alias("after"))))
                .when(kind == "delete", F.transform(r, lambda x: F.struct(x.alias("before"), none.alias("after"))))
                .when(kind == "update", pairs))
    keep = [c for c in events.columns if c != rows]
    return events.select(*keep, F.posexplode(changes).alias("row_no", "c")).select(*keep, "row_no", "c.before", "c.after")


def drop_empty(events: DataFrame) -> DataFrame:
    """Drop events without images unless they are queries."""
    return events.filter((F.size("rows") > 0) | (F.col("event_type") == "query"))


def envelope(changes: DataFrame) -> DataFrame:
    """The published envelope (binlog, db, table, query, event_type, primary, before, after, timestamp)."""
    return changes.select(
        position_label("log_file", "log_pos").alias("binlog"),
        "db", F.col("tbl").alias("table"), "query", "event_type", "primary",
        "before", "after", event_seconds("ev_ts").alias("timestamp"),
        *[c for c in ("pos_key", "row_no", "after_present") if c in changes.columns])


_KEEP_NULLS = {"ignoreNullFields": "false"}


def _image_json(c: str) -> Column:
    # An absent image is an empty object, not null; null fields inside an image stay JSON null.
    return F.coalesce(F.to_json(F.col(c), _KEEP_NULLS), F.lit("{}"))


def envelope_text(with_mask: bool = False, with_row_no: bool = False) -> Column:
    """JSON text of the envelope columns, keys in envelope order.

    The scalar head is one ``to_json`` of a struct (it always ends in ``}``);
    the two images are spliced in as their own ``to_json`` text, so no value
    is serialised twice.  ``with_mask`` adds ``after_present`` (partial images),
    ``with_row_no`` the place of the change in a multi-row event.
    """
    head = F.to_json(F.struct("binlog", "db", "table", "query", "event_type", "primary"), _KEEP_NULLS)
    return F.concat(head.substr(F.lit(1), F.length(head) - 1),
                    F.lit(',"before":'), _image_json("before"), F.lit(',"after":'), _image_json("after"),
                    F.lit(',"timestamp":'), F.coalesce(F.col("timestamp").cast("string"), F.lit("null")),
                    *([F.lit(',"after_present":'), F.coalesce(F.col("after_present").cast("string"), F.lit("null"))]
                      if with_mask else []),
                    *([F.lit(',"row_no":'), F.coalesce(F.col("row_no").cast("string"), F.lit("0"))]
                      if with_row_no else []),
                    F.lit("}"))


def envelope_json(env: DataFrame, column: str = "value") -> DataFrame:
    """Serialise envelopes to JSON text (position columns kept beside it)."""
    keep = [c for c in ("pos_key", "row_no", "db", "table") if c in env.columns]
    return env.select(*keep, envelope_text().alias(column))


def parse_envelope_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Parse published JSON envelopes back into typed columns."""
    from ..model import JSON_ENVELOPE
    return df.select(F.from_json(F.col(column), JSON_ENVELOPE).alias("e")).select("e.*")


# Header fields of the published envelope and their types.
ENVELOPE_HEAD = (("binlog", "string"), ("db", "string"), ("table", "string"), ("query", "string"),
                 ("event_type", "string"), ("primary", "string"), ("timestamp", "bigint"))


def parse_envelope_variant(df: DataFrame, column: str = "value") -> DataFrame:
    """S2 for a feed that mixes tables: typed header fields, images kept as ``variant``.

    One queue carries every table, so no single struct schema fits the images;
    route on the header first, then type each table's images (``typed_images``).
    Text that is not JSON gives ``malformed = true`` and null fields instead of
    failing the job (route it to the dead letters).
    """
    v = F.try_parse_json(F.col(column))
    head = [F.try_variant_get(v, f"$.{n}", t).alias(n) for n, t in ENVELOPE_HEAD]
    images = [F.try_variant_get(v, f"$.{side}", "variant").alias(side) for side in ("before", "after")]
    keep = [c for c in df.columns if c != column]
    return df.select(*keep, *head, *images, v.isNull().alias("malformed"))


def image_size(col: str) -> Column:
    """Number of fields of a variant image (0 for ``{}``, null when absent)."""
    return F.size(F.try_variant_get(F.col(col), "$", "map<string,variant>"))


def typed_images(env: DataFrame, schema: str) -> DataFrame:
    """Images of one routed table as its struct (DDL ``schema``); an empty image ``{}`` becomes null."""
    def typed(side: str) -> Column:
        return F.when(image_size(side) > 0, F.try_variant_get(F.col(side), "$", schema))
    return env.withColumn("before", typed("before")).withColumn("after", typed("after"))


def image_types(parsed: DataFrame) -> DataFrame:
    """(db, table, image): the struct type of each table's images, learnt from all of them.

    Every image is a variant; the types of a table's images are merged field by field, so a field that
    appears in mid-feed is in the type, and one whose numbers widen gets the wider type.  A field that
    was always null is a string, one of several kinds stays a variant.  Partial aggregation: a task
    hands over one type for each table.
    """
    sides = parsed.where(~F.col("malformed") & F.col("table").isNotNull()).select("db", "table", F.explode(F.array("before", "after")).alias("image"))
    learnt = sides.where(image_size("image") > 0).groupBy("db", "table").agg(F.schema_of_variant_agg("image").alias("image"))
    ddl = F.regexp_replace(F.regexp_replace("image", r"\bOBJECT<", "struct<"), r"\bVOID\b", "string")
    return learnt.select("db", "table", ddl.alias("image"))


def typed_by_table(parsed: DataFrame, types: DataFrame) -> dict[tuple[str, str], DataFrame]:
    """Each table's rows with typed images; ``types`` (one row a table) says how."""
    return {(r["db"], r["table"]): typed_images(parsed.where((F.col("db") == r["db"]) & (F.col("table") == r["table"])), r["image"])
            for r in types.collect()}


def query_passthrough(changes: DataFrame) -> DataFrame:
    """Query events keep their SQL text and empty images."""
    return envelope(changes.filter(F.col("event_type") == "query"))


def name_columns(values: Column, names: list[str]) -> Column:
    """Name positional values by column ordinal."""
    return F.struct(*[F.try_element_at(values, F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def change_events(changes: DataFrame) -> DataFrame:
    """Events as a binlog delivers them: each change with its image array, a row
    change followed by its transaction's XID commit event (code 16, no images)."""
    empty = F.array().cast(f"array<{changes.schema['after'].dataType.simpleString()}>")
    et = F.col("event_type")
    rows = (F.when(et == "insert", F.array("after"))
             .when(et == "delete", F.array("before"))
             .when(et == "update", F.array("before", "after"))
             .otherwise(empty))
    ev = F.struct(et.alias("event_type"), F.col("log_pos"), rows.alias("rows"))
    xid = F.struct(F.lit("16").alias("event_type"), (F.col("log_pos") + 60).alias("log_pos"),
                   empty.alias("rows"))
    evs = F.when(et == "query", F.array(ev)).otherwise(F.array(ev, xid))
    return (changes.select("log_file", "file_no", "db", "tbl", "query", "ev_ts", F.explode(evs).alias("e"))
                   .select("log_file", "file_no", "e.log_pos", "db", "tbl", "e.event_type", "query",
                           "ev_ts", "e.rows"))
