"""Schema tracking from the log itself.

A table's schema changes only at DDL positions, so a schema version is valid
on ``[ddl pos_key, next ddl pos_key)``.  Events resolve their schema by an
as-of join on position -- never with today's schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import decode as D
from . import ddl
from .consume import ORDER, pos_bucket
from .joins import asof_join, lookup_join
from .lineage import alternating, follow, landed
from .ordered import keyed_window, shift_bucket


def ddl_target(query) -> Column:
    """(kind, db named in the SQL or '', table) of a DDL statement."""
    return ddl.target(ddl.marked(query))


def ddl_tables(query) -> Column:
    """Every (db or '', table) that a DDL statement names: all of a ``DROP TABLE a, b`` list,
    the old and the new names of a rename."""
    return _tables(ddl.marked(query))


def _tables(mark: Column) -> Column:
    def table(m: Column, side: str) -> Column:
        old = side == "old"
        return F.struct(m["sql_db" if old else "new_db"].alias("sql_db"), m["tbl" if old else "new_tbl"].alias("tbl"))

    each = F.flatten(F.transform(ddl.table_moves(mark), lambda m: F.array(table(m, "old"), table(m, "new"))))
    none = F.array(F.struct(F.lit("").alias("sql_db"), F.lit("").alias("tbl")))
    return ddl.let(F.array_distinct(F.filter(each, lambda t: t["tbl"] != "")), lambda named: F.when(F.size(named) > 0, named).otherwise(none))


def column_clauses(query) -> Column:
    """What an ALTER TABLE does to columns: array of (action, column, new_name, type), in order.

    Several clauses and ``ADD (a INT, b INT)`` lists count one by one; indexes, keys and
    constraints are no columns.  Other statements give an empty array.
    """
    return _column_clauses(ddl.marked(query))


def _column_clauses(mark: Column) -> Column:
    def of(m: Column) -> Column:
        columns = F.filter(ddl.actions(m), lambda x: x["column"].isNotNull() & m.rlike(r"(?i)^ALTER "))
        return F.transform(columns, lambda x: F.struct(*[x[f].alias(f) for f in ("action", "column", "new_name", "type")]))

    return ddl.let(mark, of)


def columns_added(query) -> Column:
    """Columns that a statement adds, less those it drops."""
    return _net(column_clauses(query))


def _net(clauses: Column) -> Column:
    return ddl.let(clauses, lambda c: F.size(F.filter(c, lambda x: x["action"] == "add")) - F.size(F.filter(c, lambda x: x["action"] == "drop"))).cast("long")


def ddl_changes(changes: DataFrame) -> DataFrame:
    """C3 + C5: DDL query events with the table they change; the event's db when the SQL names none."""
    return _parsed(changes).drop("__mark")


def _parsed(changes: DataFrame) -> DataFrame:
    """``ddl_changes`` with the statement's marked text, which is made once for each event."""
    q = changes.filter(F.col("event_type") == "query").select("*", ddl.marked("query").alias("__mark"))
    q = q.select("*", ddl.target(F.col("__mark"))["kind"].alias("__kind"), F.explode(_tables(F.col("__mark"))).alias("__t"))
    q = q.filter(F.col("__t.tbl") != "")
    return q.select(*[c for c in changes.columns if c not in ("db", "tbl")], "__mark",
                    F.col("__kind").alias("ddl_kind"),
                    F.coalesce(F.nullif(F.col("__t.sql_db"), F.lit("")), F.col("db")).alias("db"),
                    F.col("__t.tbl").alias("tbl"))


def schema_versions(changes: DataFrame, n_base: int) -> DataFrame:
    """C4: per table, version 0 from the log start, then one version per DDL.

    ``n_columns`` counts the ``n_base`` columns tables start with, plus the columns added
    and less those dropped up to the version.  Version number, end position and the
    running count of columns come from one ``keyed_window`` (so a table with a long DDL
    history is not pinned to one task); version 0 of every table that has
    changes comes from one hash aggregate over changes and DDL positions.
    """
    # landed: the window and the marks read it several times, and a statement is parsed once
    d0 = landed(_parsed(changes).select("db", "tbl", "pos_key", "row_no", _net(_column_clauses(F.col("__mark"))).alias("__add")), "ddl-changes")
    ddl = keyed_window(d0, ["db", "tbl"], ORDER, pos_bucket(), lead=["pos_key"], sums=["__add"], seq="version")
    versions = ddl.select("db", "tbl", "version", F.col("pos_key").alias("valid_from"),
                          F.col("next_pos_key").alias("valid_to"),
                          (F.lit(n_base) + F.col("sum___add")).cast("long").alias("n_columns"))
    marks = (changes.select("db", "tbl", F.lit(True).alias("__chg"), F.lit(None).cast("long").alias("__ddl"))
             .unionByName(d0.select("db", "tbl", F.lit(False).alias("__chg"), F.col("pos_key").alias("__ddl"))))
    first = (marks.groupBy("db", "tbl").agg(F.max("__chg").alias("__chg"), F.min("__ddl").alias("__first"))
                  .filter(F.col("__chg")))
    initial = first.select("db", "tbl", F.lit(0).cast("long").alias("version"),
                           F.lit(0).cast("long").alias("valid_from"), F.col("__first").alias("valid_to"),
                           F.lit(n_base).cast("long").alias("n_columns"))
    return initial.unionByName(versions)


def schema_asof(changes: DataFrame, versions: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Each change with the schema version valid at its position."""
    kw = {} if max_rows is None else {"max_rows": max_rows}
    return asof_join(changes, versions, ["db", "tbl"], **kw)


def catalogue(changes: DataFrame, base_columns, added_key: Column) -> DataFrame:
    """SCHEMA_HISTORY rows: base columns (name, type, key, extra) from the log start, then one per added column.

    ``added_key``: the key kind of a column added by a DDL, from that event's columns.
    """
    tables = changes.select("db", "tbl").distinct()
    base = tables.select("db", "tbl", F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(n).alias("column_name"), F.lit(t).alias("column_type"),
                 F.lit(k).alias("column_key"), F.lit(e).alias("extra"))
        for i, (n, t, k, e) in enumerate(base_columns)])).alias("c"))
    base = base.select("db", "tbl", "c.*", F.lit(0).cast("long").alias("valid_from"))
    adds = F.filter(column_clauses("query"), lambda x: x["action"] == "add")
    ddl = ddl_changes(changes).select("db", "tbl", "pos_key", "row_no", added_key.alias("__key"), F.posexplode(adds).alias("__i", "__c"))
    ddl = keyed_window(ddl, ["db", "tbl"], [*ORDER, "__i"], pos_bucket(), seq="__k")
    added = ddl.select("db", "tbl", (F.col("__k") + len(base_columns)).cast("int").alias("ordinal"),
                       F.col("__c.column").alias("column_name"), F.col("__c.type").alias("column_type"),
                       F.col("__key").alias("column_key"), F.lit("").alias("extra"), F.col("pos_key").alias("valid_from"))
    return base.unionByName(added).withColumn("valid_to", F.lit(None).cast("long"))


def primary_keys(cat: DataFrame, sep: str = ",") -> DataFrame:
    """Key columns of each table in ordinal order; ``primary`` = the last one.

    The per-table list is bounded by the table's column count.
    """
    k = cat.filter(F.col("column_key") == "PRI")
    agg = k.groupBy("db", "tbl").agg(F.array_sort(F.collect_list(F.struct("ordinal", "column_name"))).alias("__k"))
    names = F.transform("__k", lambda s: s["column_name"])
    return agg.select("db", "tbl", F.array_join(names, sep).alias("primary_keys"),
                      F.element_at(names, -1).alias("primary"), F.size("__k").alias("n_keys"))


def attach_primary(changes: DataFrame, keys: DataFrame) -> DataFrame:
    """Each change with its table's key columns (lookup side size-checked)."""
    return lookup_join(changes, keys.select("db", "tbl", "primary_keys", "primary"), ["db", "tbl"], "left")


def known_tables(changes: DataFrame, cat: DataFrame) -> DataFrame:
    """Changes of tables the catalogue knows."""
    return lookup_join(changes, cat.select("db", "tbl").distinct(), ["db", "tbl"], "left_semi")


# ---- tables and columns through time (C1, C3, C4) --------------------------------------
POINT = ["pos_key", "row_no", "part"]
NAME = ["db", "tbl"]


def ddl_statements(changes: DataFrame) -> DataFrame:
    """The query events that are DDL, parsed once: (db, pos_key, row_no, moves, acts), landed.

    ``moves`` and ``acts`` are what the statement does to tables (``ddl.table_moves``) and to the
    columns and keys of its table (``ddl.actions``).
    """
    q = changes.where(F.col("event_type") == "query").select("db", "pos_key", "row_no", ddl.marked("query").alias("mark"))
    q = q.where(F.col("mark") != "").select("*", ddl.table_moves(F.col("mark")).alias("moves"), ddl.actions(F.col("mark")).alias("acts"))
    return landed(q.drop("mark"), "ddl")


def table_lives(changes: DataFrame, statements: DataFrame) -> DataFrame:
    """Lives of table names: (life, db, tbl, from_pos, from_row, to_pos, to_row, how, table).

    A life starts at the log's start, at a CREATE or at a rename, and ends at a DROP or a rename
    (``to_pos`` null: it lives on).  ``table`` is the first life of the same table: renames lead
    back to it however long the chain.  Ids are texts: position, row and place in the statement.
    """
    moves = statements.select("db", "pos_key", "row_no", F.posexplode("moves").alias("part", "m"))
    named = F.coalesce(F.nullif(F.col("m.sql_db"), F.lit("")), F.col("db"))
    renamed = F.coalesce(F.nullif(F.col("m.new_db"), F.lit("")), F.col("db"))
    kind = F.col("m.action")
    old = moves.select(named.alias("db"), F.col("m.tbl").alias("tbl"), *POINT, kind.alias("how"), (F.col("part") * 2).alias("place"),
                       F.when(kind == "create", 1).when(kind.isin("drop", "drop_if", "rename"), 0).alias("side"))
    new = moves.where(kind == "rename").select(renamed.alias("db"), F.col("m.new_tbl").alias("tbl"), *POINT, kind.alias("how"),
                                               (F.col("part") * 2 + 1).alias("place"), F.lit(1).alias("side"))
    events = old.unionByName(new).where(F.col("tbl") != "")
    # names that are used, ended or changed before anything starts them were there at the log's start
    seen = changes.where(F.col("event_type") != "query").groupBy(*NAME).agg(F.min(F.struct("pos_key", "row_no", F.lit(0).alias("place"), F.lit(0).alias("start"))).alias("f"))
    marks = events.where(F.col("how") != "drop_if").select(*NAME, F.struct("pos_key", "row_no", "place", F.coalesce("side", F.lit(0)).alias("start")).alias("f"))
    first = seen.unionByName(marks).groupBy(*NAME).agg(F.min("f").alias("f")).where(F.col("f.start") == 0)
    begun = first.select(*NAME, F.lit(0).cast("long").alias("pos_key"), F.lit(-1).alias("row_no"), F.lit(0).alias("part"), F.lit("start").alias("how"),
                         F.lit(0).alias("place"), F.lit(1).alias("side"))
    events = events.unionByName(begun).withColumn("life", F.concat_ws(":", "pos_key", "row_no", "place", "db", "tbl"))
    order = ["pos_key", "row_no", "place"]
    events = alternating(events, NAME, order, pos_bucket()).where(F.col("side").isNotNull())
    events = keyed_window(events, NAME, order, pos_bucket(), lag=["life"], lead=["pos_key", "row_no"])
    # a rename's end and start stand side by side in the statement: the life that ended is the one before
    ended = events.where((F.col("side") == 0) & (F.col("how") == "rename")).select(
        "pos_key", "row_no", (F.col("place") + 1).alias("place"), F.col("prev_life").alias("parent"))
    lives = events.where(F.col("side") == 1).join(ended, order, "left")
    roots = follow(lives.select(F.col("life").alias("id"), "parent"), name="table-chains")
    return landed(lives.join(roots.select(F.col("id").alias("life"), F.col("root").alias("table")), "life").select(
        "life", *NAME, F.col("pos_key").alias("from_pos"), F.col("row_no").alias("from_row"), F.col("next_pos_key").alias("to_pos"),
        F.col("next_row_no").alias("to_row"), "place", "how", "table"), "table-lives")


def life_intervals(lives: DataFrame) -> DataFrame:
    """Lives as half-open position intervals for ``asof_join``: a CREATE's own event belongs to
    the new table, the event of a rename or a DROP still to the old name."""
    start = F.col("from_pos") + F.when(F.col("how") == "rename", 1).otherwise(0)
    return (lives.select(*NAME, "life", "table", start.alias("valid_from"), (F.col("to_pos") + 1).alias("valid_to"))
            .where(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))))


def table_identity(changes: DataFrame, lives: DataFrame) -> DataFrame:
    """Each change with its table's identity, where that began, and its first and newest name.

    Columns ``table``, ``born`` (position, 0: the log's start), ``first_db``, ``first_tbl``, ``last_db``,
    ``last_tbl`` and ``n_names``; null for a name that stands for no table at the position.
    """
    at = F.struct("from_pos", "from_row", "place")
    who = lives.groupBy("table").agg(F.min_by(F.struct(*NAME, "from_pos"), at).alias("a"), F.max_by(F.struct(*NAME), at).alias("z"),
                                     F.count(F.lit(1)).alias("n_names"))
    who = landed(life_intervals(lives).drop("life").join(who, "table").select(
        *NAME, "table", F.col("a.from_pos").alias("born"), F.col("a.db").alias("first_db"), F.col("a.tbl").alias("first_tbl"),
        F.col("z.db").alias("last_db"), F.col("z.tbl").alias("last_tbl"), "n_names", "valid_from", "valid_to"), "table-names")
    return asof_join(changes, who, NAME).drop("valid_from", "valid_to")


def schema_columns(changes: DataFrame, base_columns: Sequence[tuple], statements: DataFrame | None = None,
                   lives: DataFrame | None = None) -> DataFrame:
    """C1 + C4: the ordered columns of every version of every table.

    (db, tbl, version, ordinal, name, type, key, valid_from, valid_to, table).  Version 0 holds
    ``base_columns`` (name, type, key, ..) for tables that were there at the log's start and the
    created columns for others; each later statement that changes the table starts a version, under the
    name the table has then.  ``valid_to`` is null for the newest version of a table that still lives.

    No statement list is folded in sequence.  Each column is a row from the clause that opens it to the
    next one on its name; what a clause leaves open (a rename its type, a MODIFY without FIRST or
    AFTER its place) comes from the row before it, followed through renames by ``follow``.  Places
    form a tree: a column hangs under the column it was put AFTER, newer ones nearer; FIRST and
    appended columns hang under the table, newest first and oldest first.  A column that moved or
    went leaves its place behind, so the order of a version is the order of the tree's paths
    among the columns that live in it.  Paths are as long as places are nested.  A column name that
    a clause mentions while no such column lives, is passed over.
    """
    statements = ddl_statements(changes) if statements is None else statements
    lives = table_lives(changes, statements) if lives is None else lives
    acts = _table_actions(statements, lives, base_columns)
    versions = _versions(statements, lives)
    acts = landed(acts.join(versions.select("table", "pos_key", "row_no", "version"), ["table", "pos_key", "row_no"]), "column-actions")
    states, probes = _column_states(acts)
    spans = states.join(versions.groupBy("table").agg(F.max("version").alias("newest")), "table")
    spans = spans.select("table", "sid", "cid", "name", "type", "path",
                         F.explode(F.sequence(F.col("version"), F.coalesce(F.col("next_version") - 1, F.col("newest")))).alias("version"))
    spans = landed(spans, "version-columns")
    keys = _key_spans(acts, probes, versions, spans)
    out = spans.join(keys, ["table", "version", "cid"], "left").join(versions.drop("pos_key", "row_no"), ["table", "version"])
    # a table has a few thousand columns at most
    ordinal = F.row_number().over(Window.partitionBy("table", "version").orderBy("path"))
    return out.select(*NAME, "version", ordinal.alias("ordinal"), "name", "type", F.coalesce("key", F.lit("")).alias("key"), "valid_from", "valid_to", "table")


def decode_by_schema(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """C1 with D1-D3, D11-D13, D17-D19: stored cells in long form, each decoded by the column its table had at its position.

    ``cells`` hold db, tbl, pos_key, ordinal and ``stored`` (the integer of the row image); ``columns`` are
    ``schema_columns``.  Adds ``name``, ``type``, ``key``, the flags of ``column_flags`` and of ``by_type``
    ``kind``, ``value`` and ``error``; cells with an error are the quarantine (``sinks.publish.split_dead_letters``).
    """
    # type texts are taken apart once for each column of a version, not for each cell
    spans = columns.select(*NAME, "ordinal", "name", "type", "key", "valid_from", "valid_to", D.type_parts("type").alias("__parts"),
                           D.column_flags("type", "key", F.lit("")).alias("f"))
    decoded = asof_join(cells, spans, [*NAME, "ordinal"]).withColumn("d", D.by_type_parts("stored", "__parts"))
    return decoded.select(*cells.columns, "name", "type", "key", F.col("f.is_bool").alias("is_bool"), F.col("f.unsigned").alias("unsigned"), "d.kind", "d.value",
                          F.col("d.error").alias("error"))


def keys_of_versions(columns: DataFrame, sep: str = ",") -> DataFrame:
    """R8 + C4: the key columns of every version of ``schema_columns``, key clauses, renames and drops honoured.

    ``primary_keys`` in ordinal order, ``primary`` the last of them, ``n_keys`` and ``n_columns``; a version
    without a primary key has an empty text, null and 0.  A list is bounded by a table's columns.
    """
    version = [*NAME, "version", "valid_from", "valid_to"]
    found = F.array_sort(F.collect_list(F.when(F.col("key") == "PRI", F.struct("ordinal", "name"))))
    names = F.transform("k", lambda x: x["name"])
    return columns.groupBy(*version).agg(found.alias("k"), F.count(F.lit(1)).alias("n_columns")).select(
        *version, F.array_join(names, sep).alias("primary_keys"), F.when(F.size("k") > 0, F.element_at(names, -1)).alias("primary"),
        F.size("k").alias("n_keys"), "n_columns")


def _table_actions(statements: DataFrame, lives: DataFrame, base_columns: Sequence[tuple]) -> DataFrame:
    """(table, pos_key, row_no, part, n, act): column and key actions by table, numbered in log order."""
    move = F.col("moves")[0]
    rows = statements.where(F.size("moves") > 0).select(
        F.coalesce(F.nullif(move["sql_db"], F.lit("")), F.col("db")).alias("db"), move["tbl"].alias("tbl"), "pos_key", "row_no",
        F.posexplode("acts").alias("part", "act"))
    rows = asof_join(rows, life_intervals(lives).drop("life"), NAME).where(F.col("table").isNotNull())
    act_type = rows.schema["act"].dataType.simpleString()
    given = []
    for c in base_columns:
        name, kind, key = F.lit(c[0]), F.lit(c[1]), c[2]
        given.append(F.struct(F.lit("add").alias("action"), name.alias("column"), F.lit(None).alias("new_name"), kind.alias("type"), F.lit(None).alias("place"),
                              F.lit(None).alias("anchor"), F.lit(None).alias("key_name"), F.lit(None).alias("key_kind"), F.lit(None).alias("key_columns")).cast(act_type))
        if key:
            given.append(F.struct(F.lit("add_key").alias("action"), F.lit(None).alias("column"), F.lit(None).alias("new_name"), F.lit(None).alias("type"),
                                  F.lit(None).alias("place"), F.lit(None).alias("anchor"), F.lit(ddl.PRIMARY if key == "PRI" else c[0]).alias("key_name"),
                                  F.lit(key).alias("key_kind"), F.array(name).alias("key_columns")).cast(act_type))
    at_start = lives.where(F.col("how") == "start").select("table", F.col("from_pos").alias("pos_key"), F.col("from_row").alias("row_no"),
                                                          F.posexplode(F.array(*given)).alias("part", "act"))
    rows = landed(rows.select("table", *POINT, "act").unionByName(at_start), "actions")
    return keyed_window(rows, ["table"], POINT, pos_bucket(), seq="n")


def _versions(statements: DataFrame, lives: DataFrame) -> DataFrame:
    """(table, version, pos_key, row_no, db, tbl, valid_from, valid_to), one for each statement that changes a table."""
    moves = statements.select("db", "pos_key", "row_no", F.explode("moves").alias("m"), F.size("acts").alias("n_acts"))
    moves = moves.where((F.col("m.action") == "change") & (F.col("n_acts") > 0) | (F.col("m.action") == "rename"))
    changed = asof_join(moves.select(F.coalesce(F.nullif(F.col("m.sql_db"), F.lit("")), F.col("db")).alias("db"), F.col("m.tbl").alias("tbl"), "pos_key", "row_no"),
                        life_intervals(lives).drop("life"), NAME).where(F.col("table").isNotNull())
    opened = lives.select("table", F.col("from_pos").alias("pos_key"), F.col("from_row").alias("row_no"), *[F.col(c).alias(f"named_{c}") for c in NAME], "place")
    points = (changed.select("table", "pos_key", "row_no", *[F.lit(None).cast("string").alias(f"named_{c}") for c in NAME], F.lit(None).cast("int").alias("place"))
              .unionByName(opened).groupBy("table", "pos_key", "row_no")
              .agg(*[F.max_by(f"named_{c}", "place").alias(f"named_{c}") for c in NAME]))
    end = lives.groupBy("table").agg(F.max_by(F.struct("to_pos"), F.struct("from_pos", "from_row", "place")).alias("e")).select("table", F.col("e.to_pos").alias("gone"))
    v = keyed_window(landed(points, "table-points"), ["table"], ["pos_key", "row_no"], pos_bucket(), lead=["pos_key"], fill=[f"named_{c}" for c in NAME], seq="seq")
    return landed(v.join(end, "table").select("table", (F.col("seq") - 1).alias("version"), "pos_key", "row_no", *[F.col(f"fill_named_{c}").alias(c) for c in NAME],
                                              F.col("pos_key").alias("valid_from"), F.coalesce("next_pos_key", "gone").alias("valid_to")), "table-versions")


def _column_states(acts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """States of columns, and the state that each probed name (an anchor, a key's column) stood for.

    States: (table, sid, cid, name, type, path, version, next_version).  ``sid`` is table and clause
    number, ``cid`` the first state of the same column.
    """
    a, low = F.col("act"), lambda c: F.lower(c).alias("low")
    kind, moved = a["action"], F.lower(a["column"]) != F.lower(F.coalesce(a["new_name"], a["column"]))
    own = acts.where(a["column"].isNotNull())
    void = F.lit(None).cast("int")

    def rows(df: DataFrame, name: Column, turn: int, side: Column, probe: bool = False) -> DataFrame:
        return df.select("table", low(name), "pos_key", "n", F.lit(turn).alias("turn"), side.alias("side"), F.lit(probe).alias("probe"),
                         F.coalesce(a["new_name"], a["column"]).alias("name"), a["type"].alias("type"), a["place"].alias("place"),
                         F.when(kind == "add", True).otherwise(a["place"].isNotNull()).alias("placed"), "version")

    uses = (kind.isin("modify", "change", "rename")) & ~moved
    events = (rows(own.where(kind == "add"), a["column"], 2, F.lit(1))
              .unionByName(rows(own.where(uses), a["column"], 2, void))
              .unionByName(rows(own.where((kind == "drop") | moved), a["column"], 1, F.lit(0)))
              .unionByName(rows(own.where(moved), a["new_name"], 2, F.lit(1))))
    order = ["n", "turn"]
    bucket = shift_bucket("n", 20)
    events = alternating(events, ["table", "low"], order, bucket)
    anchors = rows(own.where(a["anchor"].isNotNull()), a["anchor"], 0, void, True)
    members = rows(acts.where(a["key_columns"].isNotNull()).select("*", F.explode(a["key_columns"]).alias("member")), F.col("member"), 0, void, True)
    # "now": the state that a name stands for after the row, -1 once it has ended
    events = events.withColumn("now", F.when(F.coalesce("side", F.lit(1)) == 1, F.col("n")).otherwise(F.lit(-1)))
    asked = landed(anchors.unionByName(members).distinct().withColumn("now", F.lit(None).cast("long")).unionByName(events), "column-probes")
    probes = landed(keyed_window(asked, ["table", "low"], order, bucket, before=["now"]).where("probe").select(
        "table", "low", "n", F.nullif("before_now", F.lit(-1)).alias("state")), "column-probes")
    events = landed(keyed_window(events, ["table", "low"], order, bucket, before=["now"], lead=["version"]), "column-events")
    opened = events.where(F.coalesce("side", F.lit(1)) == 1)
    # the state before: on the same name, or on the old name where a rename ended it
    ended = events.where(F.col("side") == 0).select("table", "n", F.col("before_now").alias("was"))
    opened = opened.join(ended, ["table", "n"], "left")
    before = F.when(F.col("side").isNull(), F.col("before_now")).otherwise(F.col("was"))
    opened = landed(opened.select("*", _sid(F.col("n")).alias("sid"), _sid(before).alias("parent")), "column-states")
    first = follow(opened.select(F.col("sid").alias("id"), "parent"), name="column-first")
    typed = follow(opened.select(F.col("sid").alias("id"), F.when(F.col("type").isNull(), F.col("parent")).alias("parent")), name="column-type")
    placed = follow(opened.select(F.col("sid").alias("id"), F.when(~F.col("placed"), F.col("parent")).alias("parent")), name="column-place")
    paths = _paths(opened, anchors, probes, placed)
    types = typed.join(opened.select(F.col("sid").alias("root"), F.col("type").alias("its_type")), "root").select(F.col("id").alias("sid"), "its_type")
    where = placed.join(paths.select(F.col("id").alias("root"), F.col("value").alias("path")), "root").select(F.col("id").alias("sid"), "path")
    states = (opened.join(first.select(F.col("id").alias("sid"), F.col("root").alias("cid")), "sid").join(types, "sid").join(where, "sid")
              .select("table", "sid", "cid", "name", F.col("its_type").alias("type"), "path", "version", "next_version"))
    states = landed(states.where(F.col("next_version").isNull() | (F.col("next_version") > F.col("version"))), "column-spans")
    probed = probes.where(F.col("state").isNotNull()).select("table", "low", "n", _sid(F.col("state")).alias("sid"))
    return states, probed.join(first.select(F.col("id").alias("sid"), F.col("root").alias("cid")), "sid")


def _sid(n: Column) -> Column:
    """The id of the state that a table's clause number ``n`` opened; null where a name stood for nothing."""
    return F.when(n > 0, F.concat(F.col("table"), F.lit("#"), n.cast("string")))


def _paths(opened: DataFrame, anchors: DataFrame, probes: DataFrame, placed: DataFrame) -> DataFrame:
    """(id, value): each place's path of sort keys from the table down."""
    n = F.col("n")
    asked = anchors.select("table", "n", F.col("low")).distinct().join(probes.where(F.col("state").isNotNull()), ["table", "low", "n"]).select(
        "table", "n", _sid(F.col("state")).alias("id"))
    under = asked.join(placed, "id").select("table", "n", F.col("root").alias("under"))
    spots = opened.where("placed").join(under, ["table", "n"], "left")
    hangs = (F.col("place") == "after") & F.col("under").isNotNull()
    key = F.when(hangs, F.array(-n)).when(F.col("place") == "first", F.array(F.lit(0).cast("long"), -n)).otherwise(F.array(F.lit(1).cast("long"), n))
    links = spots.select(F.col("sid").alias("id"), F.when(hangs, F.col("under")).alias("parent"), key.alias("value"))
    return follow(links, lambda own, above: F.concat(above, own), "column-paths")


def _key_spans(acts: DataFrame, probes: DataFrame, versions: DataFrame, spans: DataFrame) -> DataFrame:
    """(table, version, cid, key): the strongest key that a column of a version is part of.

    PRI: in the primary key; UNI: alone in a unique one; MUL: first in another.  A column that was
    dropped is no part of its keys any more; a key lasts until its name is dropped or defined again.
    """
    a = F.col("act")
    events = acts.where(a["key_name"].isNotNull()).select(
        "table", F.lower(a["key_name"]).alias("key_name"), "n", (a["action"] == "add_key").alias("starts"), a["key_kind"].alias("kind"),
        a["key_columns"].alias("columns"), "version")
    lives = keyed_window(landed(events, "key-events"), ["table", "key_name"], ["n"], shift_bucket("n", 20), lead=["version"]).where("starts")
    each = lives.select("table", "n", "kind", "version", "next_version", F.posexplode("columns").alias("at", "column"))
    each = each.withColumn("low", F.lower("column")).join(probes, ["table", "low", "n"])
    each = each.join(versions.groupBy("table").agg(F.max("version").alias("newest")), "table")
    last = F.coalesce(F.col("next_version") - 1, F.col("newest"))
    each = each.where(last >= F.col("version")).select("table", "n", "cid", "kind", "at", F.explode(F.sequence(F.col("version"), last)).alias("version"))
    each = each.join(spans.select("table", "version", "cid"), ["table", "version", "cid"])
    whole = Window.partitionBy("table", "version", "n")  # the columns of one key
    leads = F.col("at") == F.min("at").over(whole)
    rank = F.when(F.col("kind") == "PRI", 3).when(leads & (F.col("kind") == "UNI") & (F.count("at").over(whole) == 1), 2).when(leads, 1)
    best = each.select("table", "version", "cid", rank.alias("rank")).groupBy("table", "version", "cid").agg(F.max("rank").alias("rank"))
    r = F.col("rank")
    return best.select("table", "version", "cid", F.when(r == 3, "PRI").when(r == 2, "UNI").when(r == 1, "MUL").alias("key"))
