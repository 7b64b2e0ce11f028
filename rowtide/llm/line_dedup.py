"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line is a text's part between line feeds, without the white space around it.  It
is removed if an earlier line, by (document id, line number), equals it or is one
edit away (one character put in, taken out or replaced; that only for lines of
``min_fuzzy`` characters or more).  All lines are judged on the input, removed ones
included, so the result doesn't depend on the order of the work.

Two lines are one edit apart if they agree after at most one character is left out
of each.  So every variant with one character left out is a hashed key, and equal
keys are joined; per key the earliest line is enough, for lines that share a key
are all one edit apart:
- replaced: the key holds the length, the place left out, and the rest;
- put in or taken out: the key holds what is left of the longer line, which is the
  shorter line itself.
A key is built from the block of characters in which one is left out and the hashes
of what stands before and after that block, so its cost doesn't grow with the line.
Each line and its earliest partner are then compared by edit distance.

Before that, lines which can have no partner are put aside: one edit leaves the
first or the second half of a line unchanged, so a line whose halves no other
distinct line of equal length, or one more or less, shares needs no variants.

Blank lines stay.  Null text stays null.  Null ids come first.  Rows with the same id
and different texts are ordered by a hash of the text at equal line numbers; wholly
repeated rows are one, and each comes back with the same lines.  Text without a removed line is unchanged; ``lines_left`` is 0 if every line
that was not blank is gone.  Other columns are kept as they are, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SHUFFLED, written

WHITE = " \t\x0b\x0c\r"
BLOCK = 64  # characters among which one is left out


def _half_keys(line: Column) -> Column:
    """Hashes of both halves, cut for a partner of equal or greater length (role 0) and of one less (role 1)."""
    n = F.length(line)
    keys = []
    for role, base in ((0, n), (1, n - 1)):
        half = F.floor(base / 2).cast("int")
        keys += [F.struct(F.xxhash64(base, F.lit("first"), F.substring(line, F.lit(1), half)).alias("key"), F.lit(role).alias("role")),
                 F.struct(F.xxhash64(base, F.lit("second"), F.substring(line, n - (base - half) + 1, base - half)).alias("key"),
                          F.lit(role).alias("role"))]
    return F.array(*keys)


def _variants(line: Column, n: Column, replaced: Column, longer: Column, shorter: Column) -> Column:
    """The keys of a line; role 0: one character replaced, 1: as the longer line, 2: as the shorter line."""

    def block_keys(j: Column, size: Column) -> Column:
        """Keys of block ``j`` of a line of ``size`` characters with one left out of it."""
        start = j * BLOCK
        block = F.substring(line, start + 1, F.lit(BLOCK))
        before, after = F.xxhash64(F.substring(line, F.lit(1), start)), F.xxhash64(F.substring(line, start + BLOCK + 1, n))
        # one-element arrays name what is used for every character
        return F.flatten(F.transform(F.array(F.struct(block.alias("b"), before.alias("p"), after.alias("s"))), lambda x: F.flatten(
            F.transform(F.sequence(F.lit(1), F.length(x["b"])), lambda i: F.transform(
                F.array(F.concat(F.substring(x["b"], F.lit(1), i - 1), F.substring(x["b"], i + 1, F.lit(BLOCK)))),
                lambda rest: F.filter(F.array(
                    F.struct(F.xxhash64(F.lit("replaced"), size, j, i, x["p"], rest, x["s"]).alias("key"), F.lit(0).alias("role")),
                    F.struct(F.xxhash64(F.lit("left out"), size, j, x["p"], rest, x["s"]).alias("key"), F.lit(1).alias("role"))),
                    lambda k: (replaced & (k["role"] == 0)) | (longer & (k["role"] == 1))))[0]))))

    def own_key(j: Column) -> Column:
        """The same for the line as what a line of one more character leaves in its block ``j``."""
        start = j * BLOCK
        size = F.least(F.lit(BLOCK), n + 1 - start) - 1
        return F.struct(F.xxhash64(F.lit("left out"), n + 1, j, F.xxhash64(F.substring(line, F.lit(1), start)),
                                   F.substring(line, start + 1, size), F.xxhash64(F.substring(line, start + size + 1, n))).alias("key"),
                        F.lit(2).alias("role"))

    none = F.array().cast("array<struct<key:bigint,role:int>>")
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))
    blocks_of_longer = F.sequence(F.lit(0), F.floor(n / BLOCK).cast("int"))
    return F.concat(
        F.when(replaced | longer, F.flatten(F.transform(blocks, lambda j: block_keys(j, n)))).otherwise(none),
        F.when(shorter, F.transform(blocks_of_longer, own_key)).otherwise(none))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines that are not blank: (id, rk, no, line); rk tells rows with the same id apart."""
    lines = F.transform(F.split(F.col(text_col), "\n"), lambda x: F.btrim(x, F.lit(WHITE)))
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("rk"), F.posexplode(lines).alias("no", "line"))
            .where("line <> ''"))


def first_lines(docs: DataFrame, id_col: str, text_col: str, min_fuzzy: int) -> DataFrame:
    """The earliest occurrence (id, no, rk) of every distinct line, with the keys of its halves."""
    lines = _lines(docs, id_col, text_col)
    keyed = lines.select(F.xxhash64("line").alias("h"), F.xxhash64(F.lit("second"), "line").alias("h2"), F.struct("id", "no", "rk").alias("at"),
                         F.when(F.length("line") >= min_fuzzy, _half_keys(F.col("line"))).alias("halves"))
    return (keyed.groupBy("h", "h2").agg(F.min("at").alias("at"), F.first("halves").alias("halves"))
            .select("at.*", "halves"))


def candidates(first: DataFrame) -> DataFrame:
    """Lines with a half that another distinct line shares, and the parts they may play in a pair."""
    halves = first.where("halves IS NOT NULL").select("id", "no", "rk", F.explode("halves").alias("k")).select("id", "no", "rk", "k.*")
    shared = (halves.groupBy("key").agg(F.count_if(F.col("role") == 0).alias("n0"), F.count_if(F.col("role") == 1).alias("n1"))
              .where("n0 > 1 OR n0 > 0 AND n1 > 0"))
    parts = halves.join(shared.hint(SHUFFLED), "key").select(
        "id", "no", "rk", ((F.col("role") == 0) & (F.col("n0") > 1)).alias("replaced"),
        ((F.col("role") == 1) & (F.col("n0") > 0)).alias("longer"), ((F.col("role") == 0) & (F.col("n1") > 0)).alias("shorter"))
    return parts.groupBy("id", "rk", "no").agg(*[F.max(x).alias(x) for x in ("replaced", "longer", "shorter")])


def near_lines(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, max_broadcast: int) -> DataFrame:
    """(id, no, rk) of the lines of ``wanted`` that are one edit away from an earlier one."""
    by_row = wanted.groupBy("id", "rk").agg(F.collect_list(F.struct("no", "replaced", "longer", "shorter")).alias("w"))
    by_row = F.broadcast(by_row) if wanted.count() <= max_broadcast else by_row.hint(SHUFFLED)
    texts = docs.select(F.col(id_col).alias("did"), F.xxhash64(text_col).alias("drk"), F.split(text_col, "\n").alias("lines"))
    found = (texts.join(by_row, F.col("did").eqNullSafe(F.col("id")) & (F.col("drk") == F.col("rk")))
             .select("id", "rk", F.explode(F.transform("w", lambda w: F.struct(
                 w["no"].alias("no"), w["replaced"].alias("replaced"), w["longer"].alias("longer"), w["shorter"].alias("shorter"),
                 F.btrim(F.get("lines", w["no"]), F.lit(WHITE)).alias("line")))).alias("l"))
             .select(F.struct("id", "l.no", "rk").alias("at"), "l.line", "l.replaced", "l.longer", "l.shorter").distinct())
    found = written(found, "lines")
    keys = found.select("at", F.explode(_variants(F.col("line"), F.length("line"), F.col("replaced"), F.col("longer"),
                                                  F.col("shorter"))).alias("k")).select("at", "k.*")
    earliest = keys.groupBy("key").agg(*[F.min(F.when(F.col("role") == r, F.col("at"))).alias(f"m{r}") for r in (0, 1, 2)],
                                       F.count("*").alias("n")).where("n > 1")
    partner = F.when(F.col("role") == 0, F.col("m0")).when(F.col("role") == 1, F.col("m2")).otherwise(F.col("m1"))
    pairs = keys.join(earliest.hint(SHUFFLED), "key").select("at", partner.alias("with")).where("with < at").distinct()
    line = found.select(F.col("at").alias("a"), "line")
    other = found.select(F.col("at").alias("b"), F.col("line").alias("other"))
    checked = pairs.join(line.hint(SHUFFLED), _same("at", "a")).join(other.hint(SHUFFLED), _same("with", "b"))
    return checked.where(F.levenshtein("line", "other", 1) >= 0).select("at.*").distinct()


def _same(x: str, y: str) -> Column:
    return (F.col(f"{x}.id").eqNullSafe(F.col(f"{y}.id")) & (F.col(f"{x}.no") == F.col(f"{y}.no")) & (F.col(f"{x}.rk") == F.col(f"{y}.rk")))


def _dedup(docs: DataFrame, id_col: str, text_col: str, min_fuzzy: int, max_broadcast: int) -> DataFrame:
    """(d: the row, text: what is left, n_lines, lines_left), where n_lines counts lines that are not blank."""
    first = written(first_lines(docs, id_col, text_col, min_fuzzy), "first-lines")
    wanted = written(candidates(first), "line-candidates")
    near = near_lines(docs, wanted, id_col, text_col, max_broadcast).select(*[F.col(x).alias(f"r_{x}") for x in ("id", "no", "rk")])
    kept = first.join(near, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("no") == F.col("r_no")) & (F.col("rk") == F.col("r_rk")), "left_anti")
    kept = kept.groupBy("id", "rk").agg(F.collect_list("no").alias("kept"))
    rows = docs.select(F.struct("*").alias("d"), F.col(id_col).alias("did"), F.xxhash64(text_col).alias("drk"))
    rows = rows.join(kept, F.col("did").eqNullSafe(F.col("id")) & (F.col("drk") == F.col("rk")), "left")
    rows = rows.select("d", F.coalesce("kept", F.array().cast("array<int>")).alias("kept"), F.split(F.col("d").getField(text_col), "\n").alias("l"))
    blank = F.filter(F.sequence(F.lit(0), F.size("l") - 1), lambda i: F.btrim(F.get("l", i), F.lit(WHITE)) == "")
    rows = rows.select("d", "l", "kept", F.when(F.col("l").isNotNull(), blank).alias("blank"))
    stay = F.array_sort(F.array_union("kept", "blank"))
    return rows.select("d", F.array_join(F.transform(stay, lambda i: F.get("l", i)), "\n").alias("text"),
                       F.coalesce(F.size("l") - F.size("blank"), F.lit(0)).cast("long").alias("n_lines"),
                       F.size("kept").cast("long").alias("lines_left"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_fuzzy: int = 20,
                max_broadcast: int = 200_000) -> DataFrame:
    """(id, text, n_lines, n_removed) of every row, the text without its removed lines."""
    return _dedup(docs, id_col, text_col, min_fuzzy, max_broadcast).select(
        F.col("d").getField(id_col).alias(id_col), "text", "n_lines", (F.col("n_lines") - F.col("lines_left")).alias("n_removed"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_fuzzy: int = 20,
               max_broadcast: int = 200_000) -> DataFrame:
    """The rows with their own columns and the text that is left; rows that lost every line are gone."""
    rows = _dedup(docs, id_col, text_col, min_fuzzy, max_broadcast).where("lines_left > 0 OR n_lines = 0")
    return rows.select(*[F.col("text").alias(c) if c == text_col else F.col("d").getField(c).alias(c) for c in docs.columns])
