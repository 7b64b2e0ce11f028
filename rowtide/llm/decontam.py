"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Words become templates: numbers, units after a number and names (words with a capital
letter that don't begin a sentence) turn into typed placeholders, all other words
lose their case and the punctuation around them.  Every window of ``window`` template
words of a document is hashed and joined with the windows of the benchmark items (an
item shorter than that is one window of its own length).  Matches of an item that lie
on one diagonal (document position minus item position) are one alignment.

An alignment is a re-parameterised copy only as far as its slots are consistent: what stands
at the item's placeholders maps to what stands at the document's one to one, for
example the same other name wherever the item repeats a name.  Windows that hold a slot
which breaks the mapping are dropped, the others stay.  With ``meet`` each of the item's values
has to map to one value, and new ones may coincide.  Windows that are mostly
placeholders don't count.  A document is contaminated by an item if the matched windows
of its consistent alignments cover at least ``min_share`` of the item's countable windows, or,
with ``min_run``, if one consistent alignment matches that many words in a row, whatever
their share of the item (a shorter item then has to match by its share).

An item without countable windows (fewer than ``min_words`` template words, or every window
mostly placeholders) is sought as it stands: a document is contaminated if it holds all the
item's words in a row, in lower case without the punctuation at their ends.

Null and blank texts have no words.
Items with equal text are separate items.  Repeated documents (same id and text) are
judged as one, and each of their rows is dropped or kept alike.  Other columns don't
matter; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
UNITS = ("mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz ton tons ml l liter liters litre "
         "litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
         "mph kph c f celsius fahrenheit degrees % percent dollar dollars euro euros cent cents usd eur gbp pounds").split()
WHITE = r"\x20\x09-\x0D"
EDGE = rf"[^\p{{L}}\p{{N}}%<>{WHITE}]"  # what is taken off a word's ends
#: a capital letter first; before it a blank, and before that no end of a sentence
NAMED = rf"([^{WHITE}.!?:][\x20\x09])[\"'(\[]{{0,2}}\p{{Lu}}[\p{{L}}\p{{N}}'’-]*"
NUMBERED = r"(^|[^\p{L}\p{N}.,])\p{Nd}[\p{Nd}.,:/]*(?:st|nd|rd|th)?($|[^\p{L}\p{N}])"
MEASURED = rf"{NUMBER}([\x20\x09]+)(?:{'|'.join(sorted(UNITS, key=lambda u: (-len(u), u)))})($|[^\p{{L}}\p{{N}}])"
EDGES = rf"(^|[{WHITE}]){EDGE}+|{EDGE}+($|[{WHITE}])"
#: the same, looking at the neighbours without taking them (the SQL has no such patterns and takes two passes)
NAMED_HERE = rf"(?<=[^{WHITE}.!?:][\x20\x09])[\"'(\[]{{0,2}}\p{{Lu}}[\p{{L}}\p{{N}}'’-]*"
NUMBERED_HERE = r"(?<![\p{L}\p{N}.,])\p{Nd}[\p{Nd}.,:/]*(?:st|nd|rd|th)?(?![\p{L}\p{N}])"
EDGES_HERE = rf"(?<![^{WHITE}]){EDGE}++|{EDGE}++(?![^{WHITE}])"
MAX_ANCHORS = 20_000  # word pairs that may be told apart inside the expression; beyond, every window is hashed


def template(text: Column) -> Column:
    """Template words of a text, by four regular expressions over the whole of it; they keep every blank, so words stay in place."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), NAMED_HERE, NAME)
    t = F.regexp_replace(t, NUMBERED_HERE, NUMBER)
    t = F.regexp_replace(F.lower(t), MEASURED, f"{NUMBER}$1{UNIT}$2")
    return F.filter(F.split(F.regexp_replace(t, EDGES_HERE, ""), rf"[{WHITE}]+"), lambda w: w != "")


def raw_words(text: Column) -> Column:
    """The words that stand where the template words do, in lower case without what surrounds them."""
    kept = F.filter(F.split(text, rf"[{WHITE}]+"), lambda w: w.rlike(r"[\p{L}\p{N}%<>]"))
    return F.transform(kept, lambda w: F.regexp_replace(F.lower(w), rf"^{EDGE}+|(?:['’]s)?{EDGE}*$", ""))


def _windows(words: Column, size: Column | int) -> Column:
    """(at, h): start, from 0, and hash of each window of ``size`` words."""
    n = F.size(words) - size
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        i.alias("at"), F.xxhash64(F.slice(words, i + 1, size)).alias("h"))))


def _pair(words: Column, i: Column) -> Column:
    return F.xxhash64(F.get(words, i), F.get(words, i + 1))


def _anchored_windows(words: Column, size: int, anchors: list[int], firsts: list[str]) -> Column:
    """(at, h) of the windows of ``size`` words that hold one of the given word pairs; ``firsts`` are the pairs' first words."""
    last = F.size(words) - size
    spots = F.filter(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.get(words, i).isin(firsts) & _pair(words, i).isin(anchors))
    around = F.flatten(F.transform(spots, lambda i: F.sequence(F.greatest(i - (size - 2), F.lit(0)), F.greatest(F.least(i, last), F.lit(0)))))
    starts = F.filter(F.array_distinct(around), lambda i: i <= last)
    return F.when(last >= 0, F.transform(starts, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(words, i + 1, size)).alias("h"))))


def plain_words(text: Column) -> Column:
    """The words in lower case without what surrounds them; what has no letter or digit stays as it is."""
    words = F.filter(F.split(F.lower(text), rf"[{WHITE}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.when(
        w.rlike(r"[\p{L}\p{N}%<>]"), F.regexp_replace(w, rf"^{EDGE}+|(?:['’]s)?{EDGE}*$", "")).otherwise(w))


def _template_windows(items: DataFrame, id_col: str, text_col: str, window: int, min_words: int) -> DataFrame:
    """(item, t, size, w, starts): template words of each item row and where its countable windows start."""
    words = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("t"), template(F.col(text_col)).alias("w"))
    words = words.withColumn("size", F.least(F.size("w"), F.lit(window)))

    def countable(i: Column) -> Column:
        return 2 * F.size(F.filter(F.slice("w", i + 1, F.col("size")), lambda x: x.isin(NUMBER, UNIT, NAME))) <= F.col("size")

    starts = F.filter(F.sequence(F.lit(0), F.size("w") - F.col("size")), countable)
    return words.withColumn("starts", F.when(F.size("w") >= min_words, starts).otherwise(F.array().cast("array<int>")))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int, min_words: int) -> DataFrame:
    """(item, size, at, h, anchor, n) of the countable windows of each item, n the number of them.

    ``anchor`` is the least hash of the window's pairs of neighbouring words, with the pair's first word: a text
    without that pair lacks the window.
    """
    every = _template_windows(items, id_col, text_col, window, min_words).select("item", "size", "w", F.explode("starts").alias("at"))
    pairs = F.transform(F.sequence(F.col("at"), F.col("at") + F.col("size") - 2), lambda i: F.struct(_pair(F.col("w"), i).alias("h"), F.get("w", i).alias("first")))
    anchor = F.when(F.col("size") > 1, F.array_min(pairs))
    every = every.select("item", "size", "at", F.xxhash64(F.slice("w", F.col("at") + 1, F.col("size"))).alias("h"), anchor.alias("anchor"))
    return every.join(every.groupBy("item").agg(F.count("*").alias("n")), "item")


def plain_windows(items: DataFrame, id_col: str, text_col: str, window: int, min_words: int) -> DataFrame:
    """(item, k, size, at, h, n) of all plain windows of the items without countable ones; k tells items with the same id apart."""
    bare = _template_windows(items, id_col, text_col, window, min_words).where(F.size("starts") == 0)
    words = bare.select("item", F.xxhash64("t").alias("k"), plain_words(F.col("t")).alias("w")).where(F.size("w") > 0)
    words = words.withColumn("size", F.least(F.size("w"), F.lit(window))).withColumn("n", F.size("w") - F.col("size") + 1)
    return words.select("item", "k", "size", "n", F.explode(_windows(F.col("w"), F.col("size"))).alias("x")).select(
        "item", "k", "size", "x.at", "x.h", "n").distinct()


def _verbatim(docs: DataFrame, bench: DataFrame, id_col: str, text_col: str, max_broadcast: int) -> DataFrame | None:
    """(id, tk, item, n_matched, share): rows that hold an item of ``bench`` (``plain_windows``) word by word; None if it is empty."""
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())  # window many at most
    if not sizes:
        return None
    words = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"), plain_words(F.col(text_col)).alias("w"))
    none = F.array().cast("array<struct<at:int,h:bigint>>")
    seen = words.select("id", "tk", F.explode(F.concat(*[F.coalesce(_windows(F.col("w"), size), none) for size in sizes])).alias("x"))
    side = bench.select("item", "k", F.col("at").alias("b_at"), "h", "n")
    hits = seen.select("id", "tk", "x.at", "x.h").join(F.broadcast(side) if bench.count() <= max_broadcast else side, "h")
    whole = (hits.groupBy("id", "tk", "item", "k", (F.col("at") - F.col("b_at")).alias("diagonal"))
             .agg(F.count_distinct("b_at").alias("m"), F.first("n").alias("n")).where("m = n"))
    return whole.groupBy("id", "tk", "item").agg(F.max("m").alias("n_matched")).withColumn("share", F.lit(1.0))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = 8, min_words: int = 5, min_share: float = 0.6,
                 max_broadcast: int = 500_000, min_run: int | None = None, meet: bool = False) -> DataFrame:
    """(id, tk, item, n_matched, share): which rows, told apart by id and text hash, hold which items."""
    bench = written(benchmark_windows(items, item_col, item_text_col, window, min_words), "benchmark-windows")
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())  # window many at most
    small = bench.count() <= max_broadcast
    side = bench.select("item", F.col("at").alias("b_at"), "n", F.col("size").alias("b_size"), "h")
    words = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"), template(F.col(text_col)).alias("w"))
    empty = F.array().cast("array<struct<at:int,h:bigint>>")
    pairs = [r["anchor"] for r in bench.select("anchor").distinct().limit(MAX_ANCHORS + 1).collect()]  # of the benchmark alone
    if None in pairs or len(pairs) > MAX_ANCHORS:
        all_windows = F.concat(empty, *[F.coalesce(_windows(F.col("w"), size), empty) for size in sizes])
    else:
        words = words.where(F.size("w") > 1)
        anchors, firsts = sorted({p["h"] for p in pairs}), sorted({p["first"] for p in pairs})
        all_windows = F.concat(empty, *[F.coalesce(_anchored_windows(F.col("w"), size, anchors, firsts), empty) for size in sizes])
    seen = words.select("id", "tk", F.explode(all_windows).alias("x")).select("id", "tk", "x.at", "x.h")
    hits = seen.join(F.broadcast(side) if small else side, "h").select(
        "id", "tk", "item", "n", "b_size", "b_at", (F.col("at") - F.col("b_at")).alias("diagonal")).distinct()
    hits = written(hits, "benchmark-hits")
    line = ["id", "tk", "item", "diagonal"]
    # slots: what the item and the document have at the item's placeholders inside matched windows
    item_words = items.select(F.col(item_col).alias("item"), template(F.col(item_text_col)).alias("w"),
                              raw_words(F.col(item_text_col)).alias("v"))
    slots = (item_words.select("item", F.posexplode(F.arrays_zip("w", "v")).alias("p", "z"))
             .where(F.col("z.w").isin(NUMBER, UNIT, NAME)).select("item", F.col("p").alias("slot"), F.col("z.w").alias("kind"), F.col("z.v").alias("theirs")))
    asked = (hits.join(slots, "item").where("slot >= b_at AND slot < b_at + b_size").select(*line, "slot", "kind", "theirs").distinct())
    by_row = asked.groupBy("id", "tk").agg(F.collect_list(F.struct("item", "diagonal", "slot", "kind", "theirs")).alias("q"))
    by_row = written(by_row, "benchmark-slots")
    if by_row.select(F.coalesce(F.sum(F.size("q")), F.lit(0))).collect()[0][0] <= max_broadcast:
        by_row = F.broadcast(by_row)
    texts = docs.select(F.col(id_col).alias("did"), F.xxhash64(text_col).alias("dtk"), F.col(text_col).alias("t"))
    filled = (texts.join(by_row, F.col("did").eqNullSafe(F.col("id")) & F.col("dtk").eqNullSafe(F.col("tk")))
              .select("id", "tk", "q", raw_words(F.col("t")).alias("v"))
              .select("id", "tk", F.explode(F.transform("q", lambda q: F.struct(
                  q["item"].alias("item"), q["diagonal"].alias("diagonal"), q["slot"].alias("slot"), q["kind"].alias("kind"), q["theirs"].alias("theirs"),
                  F.get("v", q["slot"] + q["diagonal"]).alias("ours")))).alias("s")).select("id", "tk", "s.*"))
    bad = _torn_slots(filled, line, meet).select("item", "diagonal", "slot", "id", "tk")
    bad = (bad.join(hits.select("item", "b_size").distinct(), "item")
           .select(*line, F.explode(F.sequence(F.col("slot") - F.col("b_size") + 1, F.col("slot"))).alias("b_at")).distinct())
    here = [*line, "b_at"]
    good = hits.join(bad.select(*[F.col(x).alias(f"x_{x}") for x in here]), _all_same(here, "x_"), "left_anti")
    enough = F.col("n_matched") >= min_share * F.col("n")
    if min_run is not None:
        good = (good.groupBy(*line, "n", "b_size").agg(F.sort_array(F.collect_set("b_at")).alias("ats"))
                .withColumn("run", _longest_run(F.col("ats"), F.col("b_size")))
                .select("id", "tk", "item", "n", "run", F.explode("ats").alias("b_at")))
        enough = enough | (F.col("run") >= min_run)
    else:
        good = good.withColumn("run", F.lit(0))
    out = (good.groupBy("id", "tk", "item").agg(F.count_distinct("b_at").alias("n_matched"), F.first("n").alias("n"), F.max("run").alias("run"))
           .where(enough).select("id", "tk", "item", "n_matched", (F.col("n_matched") / F.col("n")).alias("share")))
    plain = written(plain_windows(items, item_col, item_text_col, window, min_words), "benchmark-plain")
    exact = _verbatim(docs, plain, id_col, text_col, max_broadcast)
    if exact is None:
        return out
    # items of one id may be of both kinds
    return (out.union(exact).groupBy("id", "tk", "item").agg(F.max(F.struct("share", "n_matched")).alias("m"))
            .select("id", "tk", "item", "m.n_matched", "m.share"))


def _torn_slots(filled: DataFrame, line: list[str], meet: bool) -> DataFrame:
    """The rows of ``filled`` whose values break the mapping of their alignment.

    Of the values that stand against one, that which is the same on both sides stays, else
    the most frequent one; where two are equally frequent none does.
    """
    same = F.col("theirs").eqNullSafe(F.col("ours"))
    pairs = filled.groupBy(*line, "theirs", "ours").agg(F.struct(F.max(same.cast("int")), F.count("*")).alias("c"),
                                                       F.collect_set("slot").alias("slots"))

    def lost(one: str) -> DataFrame:
        groups = pairs.groupBy(*line, one).agg(F.collect_list(F.struct("c", "slots")).alias("g")).where(F.size("g") > 1)
        best = F.array_max(F.transform("g", lambda x: x["c"]))
        winners = F.size(F.filter("g", lambda x: x["c"] == best))
        out = F.filter("g", lambda x: (x["c"] < best) | (winners > 1))
        return groups.select(*line, F.explode(F.flatten(F.transform(out, lambda x: x["slots"]))).alias("slot"))

    return lost("theirs") if meet else lost("theirs").union(lost("ours"))


def _longest_run(starts: Column, size: Column) -> Column:
    """Words of the longest unbroken run of matched words; windows that touch or overlap are of one run."""
    none = F.lit(None).cast("int")

    def add(s: Column, at: Column) -> Column:
        first = F.when(at - s["last"] <= size, s["first"]).otherwise(at)
        return F.struct(first.alias("first"), at.alias("last"), F.greatest(s["run"], at + size - first).alias("run"))

    return F.aggregate(starts, F.struct(none.alias("first"), none.alias("last"), F.lit(0).alias("run")), add, lambda s: s["run"])


def _all_same(columns: list[str], prefix: str) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(prefix + c))
    return same


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """One row per contaminated document and item: (id, item_id, n_matched, share)."""
    return (contaminated(docs, items, id_col=id_col, **kw)
            .select(F.col("id").alias(id_col), F.col("item").alias("item_id"), "n_matched", "share"))


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows that no benchmark item contaminates, with their own columns."""
    bad = contaminated(docs, items, id_col=id_col, text_col=text_col, **kw).select(F.col("id").alias("bad_id"), F.col("tk").alias("bad_tk")).distinct()
    rows = docs.select(F.struct("*").alias("d"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"))
    rows = rows.join(bad, F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("tk") == F.col("bad_tk")), "left_anti")
    return rows.select(*[F.col("d").getField(c).alias(c) for c in docs.columns])
