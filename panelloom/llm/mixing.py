"""Operator 3: mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.common import WORD, gapless_rank, keep_table

BLOCK = 16
SLICES = 256
SEED = 17
MOST_REPEATS = 3
WEIGHTS = 3
# A source with fewer documents, or fewer blocks, than this for every slice is cut into fewer slices.
LEAST_IN_SLICE = 64
# From so many documents on, what a very long document leaves over goes to others of its source.
MANY = 16
MADE = ("size", "source_size", "target", "taken")
# Up to so many rows about slices or single documents, a join with whole documents broadcasts them.
FEW = 100_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def water_filled(sources: DataFrame, repeats: int) -> DataFrame:
    """Adds `target`: shares of all sizes by weight, none above ``repeats`` times the source's size.

    Each round fixes every source that its share would carry above its limit; the rest is shared again
    by weight until none is above.  A round is one aggregate over the sources.
    """
    limit = repeats * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:
        full = limit <= F.lit(share) * F.col("weight")
        fixed, weight = sources.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        # No weight is left when every source is at its limit.
        wanted = (total - (fixed or 0)) / weight if weight else share
        if wanted <= share:
            break
        share = wanted
    return sources.withColumn("target", F.least(limit.cast("double"), F.lit(share) * F.col("weight")))


def seats_from(claim: Column, divisor: Column) -> Column:
    """How many Sainte-Laguë quotients claim / (k + 1/2) are above the divisor, or equal to it."""
    return F.when(divisor > 0, F.floor(claim / divisor + 0.5)).otherwise(F.lit(0)).cast("long")


def apportioned_slices(slices: DataFrame) -> DataFrame:
    """Adds `quota`: the source's `seats` dealt to its slices by the highest quotients of their sizes.

    With D = all sizes, S slices and T seats, every quotient above D / (T - S/2) surely wins and every
    one below D / (T + S/2) surely loses, so only about S quotients per source are ranked.
    """
    own = Window.partitionBy("_source")
    n, size = F.count(F.lit(1)).over(own), F.sum("slice_size").over(own)
    bounded = (slices.withColumn("_all", size.cast("double")).withColumn("_half", n / 2)
               .withColumn("sure", F.when(F.col("seats") > F.col("_half"),
                                          seats_from(F.col("slice_size"), F.col("_all") / (F.col("seats") - F.col("_half")) * 1.0000001))
                           .otherwise(F.lit(0)).cast("long"))
               .withColumn("most", seats_from(F.col("slice_size"), F.col("_all") / (F.col("seats") + F.col("_half")) * 0.9999999))
               .withColumn("open", F.col("seats") - F.sum("sure").over(own)))
    rivals = bounded.where("most > sure").select("_source", "_slice", "open", "slice_size",
                                                 F.explode(F.sequence("sure", F.col("most") - 1)).alias("k"))
    place = F.row_number().over(own.orderBy(F.desc(F.col("slice_size") / (F.col("k") + 0.5)), "_slice", "k"))
    won = (rivals.withColumn("place", place).where(F.col("place") <= F.col("open"))
           .groupBy("_source", "_slice").agg(F.count(F.lit(1)).alias("extra")))
    return (bounded.join(won, ["_source", "_slice"], "left")
            .withColumn("quota", F.col("sure") + F.coalesce("extra", F.lit(0))).drop("_all", "_half", "sure", "most", "open", "extra"))


def apportioned_sources(sources: DataFrame, block: int) -> DataFrame:
    """Adds `seats`: all blocks dealt to the sources by the highest quotients of their targets.

    Only quotients near the last winning one are ranked, about one per source, and the rank is global
    without one task seeing them all.
    """
    n, total = sources.agg(F.count(F.lit(1)), F.sum("target")).first()
    seats = int(round((total or 0) / block))
    if not seats:
        return sources.withColumn("seats", F.lit(0).cast("long"))
    half = n / 2
    sure = seats_from(F.col("target"), F.lit(total / (seats - half) * 1.0000001)) if seats > half else F.lit(0).cast("long")
    most = seats_from(F.col("target"), F.lit(total / (seats + half) * 0.9999999))
    bounded = sources.withColumn("sure", sure).withColumn("most", most)
    left = seats - (bounded.agg(F.sum("sure")).first()[0] or 0)
    rivals = (bounded.where("most > sure").select("_source", F.explode(F.sequence("sure", F.col("most") - 1)).alias("k"), "target")
              .select("_source", "k", (F.col("target") / (F.col("k") + 0.5)).alias("quotient")))
    ranked = gapless_rank(rivals, [F.desc("quotient"), F.col("_source"), F.col("k")], "place", "mix-quotients")
    won = ranked.where(F.col("place") < left).groupBy("_source").agg(F.count(F.lit(1)).alias("extra"))
    return (bounded.join(won, "_source", "left")
            .withColumn("seats", F.col("sure") + F.coalesce("extra", F.lit(0))).drop("sure", "most", "extra"))


def mix(docs: DataFrame, carried: Sequence[str] = ("doc_id",), block: int = BLOCK, slices: int = SLICES, seed: int = SEED, repeats: int = MOST_REPEATS,
        weights: int = WEIGHTS, size: Column | None = None) -> DataFrame:
    """The ``carried`` columns with `size`, `source_size`, `target` and `taken`.

    Sources by code point (NULL last, the empty name a source like others) weigh 1, 2, .. ``weights``
    and repeat.  Targets are cut into blocks of ``block`` words, dealt to sources and then to
    up to ``slices`` hash slices of each source by Sainte-Laguë, each with about LEAST_IN_SLICE documents
    and blocks at least.  A slice lays its documents end to end in
    seeded order, ``repeats`` times over, cuts this tape into equal blocks and takes as many from its
    start as its quota says.  A document is taken once for each time the tape's taken part covers it; at
    the end of that part it can be taken up to a word inside it: `taken` counts words, repeats included,
    and the last, partial copy starts at word 0.

    A text without words, or NULL, has size 0 and takes nothing.  Rows with equal ids are separate rows.
    Sources without words have target 0.  Columns that are not
    carried are ignored, and carried ones with the names above are replaced.
    """
    plain = _plain(carried)
    return _mixed(docs, plain, block, slices, seed, repeats, weights, size).select(*plain, *MADE)


def whole_copies(docs: DataFrame, carried: Sequence[str] = ("doc_id",), block: int = BLOCK, slices: int = SLICES, seed: int = SEED, repeats: int = MOST_REPEATS,
                 weights: int = WEIGHTS, size: Column | None = None) -> DataFrame:
    """The ``carried`` columns with `copies`: the mix in whole documents, with the words of each source kept.

    Only the document at the end of a slice's tape is taken in part.  These, at most one per slice, are
    rounded longest first, each to the nearest whole of its part and what the ones before left over.  If a
    source of MANY documents still has words left over or short, its other documents no longer than that
    get copies more or fewer, one in each turn of a tape through its slices, none above ``repeats``.  A
    text without words stays once.

    All this is decided on rows without the carried columns.  Along its tape a slice takes each document once more up to
    some place than from there on, so the documents themselves are told their copies by one row per slice and one for
    each document that rounding moved, and are not shuffled for it.
    """
    plain = _plain(carried)
    spot = F.struct("_draw", "_id", "size").alias("_spot")
    counted = _copies(_mixed(docs, [], block, slices, seed, repeats, weights, size), repeats)
    told = keep_table(counted.select("_source", "_piece", "_slice", spot, "size", "_whole", "copies"), "mix-copies")
    lows = told.where("size > 0").withColumn("_low", F.min("_whole").over(Window.partitionBy("_source", "_slice"))).where("_whole = _low")
    cuts = lows.groupBy("_source", "_slice").agg(F.first("_low").alias("_low"), F.min("_spot").alias("_cut"))
    pieces = keep_table(told.select("_source", "_piece", "_slice").distinct().join(cuts, ["_source", "_slice"], "left").drop("_slice"), "mix-cuts")
    usual = F.when(F.col("size") > 0, F.col("_low") + F.when(F.col("_spot") < F.col("_cut"), 1).otherwise(0)).otherwise(1).cast("int")
    moved = (told.join(_few(pieces), ["_source", "_piece"]).groupBy("_source", "_spot")
             .agg(F.min("copies").alias("_least"), F.max("copies").alias("_most"), F.first(usual).alias("_usual"))
             .where("_least <> _usual OR _most <> _usual").drop("_usual"))
    moved = keep_table(moved, "mix-moved")
    rows = (_rows(docs, plain, slices, seed, size).withColumn("_spot", spot).join(_few(pieces), ["_source", "_piece"])
            .join(_few(moved), ["_source", "_spot"], "left"))
    alike = moved.where("_least < _most").select("_source", "_spot")
    direct = rows.select(*plain, F.coalesce("_least", usual).alias("copies"), (F.col("_least") < F.col("_most")).alias("_alike"))
    if alike.isEmpty():
        return direct.drop("_alike")
    # Rows alike in id and size of which some take more copies than others are numbered, and dealt them in turn.
    shares = told.join(alike, ["_source", "_spot"], "left_semi").groupBy("_source", "_spot", "copies").agg(F.count(F.lit(1)).alias("_n"))
    last = F.sum("_n").over(Window.partitionBy("_source", "_spot").orderBy(F.desc("copies")))
    shares = keep_table(shares.select("_source", "_spot", "copies", (last - F.col("_n")).alias("_after"), last.alias("_last")), "mix-alike")
    number = F.row_number().over(Window.partitionBy("_source", "_spot").orderBy(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in plain])))
    dealt = rows.where("_least < _most").withColumn("_number", number).join(shares, ["_source", "_spot"])
    dealt = dealt.where("_number > _after AND _number <= _last").select(*plain, "copies")
    return direct.where("_alike IS NOT TRUE").drop("_alike").unionByName(dealt)


def _few(rows: DataFrame) -> DataFrame:
    """Broadcast by the join that it goes into, unless it has many rows."""
    return F.broadcast(rows) if rows.limit(FEW + 1).count() <= FEW else rows


def _copies(placed: DataFrame, repeats: int) -> DataFrame:
    """Adds `copies` to the rows of ``_mixed``, and `_whole`, how many times the tape covers all of a document."""
    narrow = keep_table(placed.select("_source", "_slice", "size", "taken", "_docs"), "mix-parts")
    cut = (F.col("size") > 0) & (F.col("taken") % F.greatest("size", F.lit(1)) > 0)
    ends = (narrow.where(cut).groupBy("_source", "_docs")
            .agg(F.sort_array(F.collect_list(F.struct("size", "_slice", (F.col("taken") % F.col("size")).alias("part"))), asc=False).alias("ends")))

    def rounded(acc: Column, e: Column) -> Column:
        up = 2 * (acc["left"] + e["part"]) >= e["size"]
        return F.struct((acc["left"] + e["part"] - F.when(up, e["size"]).otherwise(0)).alias("left"),
                        F.when(up, F.array_append(acc["up"], e["_slice"])).otherwise(acc["up"]).alias("up"))

    start = F.struct(F.lit(0).cast("long").alias("left"), F.array().cast("array<bigint>").alias("up"))
    decided = ends.select("_source", F.when(F.col("_docs") >= MANY, F.lit(1)).otherwise(0).alias("_many"), F.aggregate("ends", start, rounded).alias("_d"))
    decided = keep_table(decided.select("_source", (F.col("_d.left") * F.col("_many")).alias("_left"), F.col("_d.up").alias("_up")), "mix-rounded")
    whole = F.floor(F.col("taken") / F.greatest("size", F.lit(1)))
    room = F.when((F.col("size") > 0) & ~cut & (F.col("size") <= F.abs("_left")),
                  F.when(F.col("_left") > 0, repeats - whole).otherwise(whole)).otherwise(0)
    turns = range(1, repeats + 1)
    given = {k: F.when(room >= k, F.col("size")).otherwise(0) for k in turns}
    # A source without partial documents is not among the decided ones.
    tapes = narrow.join(decided, "_source").groupBy("_source", "_slice", "_left", F.array_contains("_up", F.col("_slice")).alias("_more")).agg(
        *[F.sum(given[k]).alias(f"_sum{k}") for k in turns])
    own = Window.partitionBy("_source")
    earlier = {k: sum((F.sum(f"_sum{j}").over(own) for j in range(1, k)), F.sum(f"_sum{k}").over(own.orderBy("_slice")) - F.col(f"_sum{k}")) for k in turns}
    tapes = tapes.select("_source", "_slice", "_left", "_more", *[earlier[k].alias(f"_before{k}") for k in turns])
    told = placed.join(tapes, ["_source", "_slice"], "left")
    middle = {k: F.col(f"_before{k}") + F.sum(given[k]).over(along()) - F.col("size") / 2 for k in turns}
    moved = sum(F.when((room >= k) & (middle[k] <= F.abs("_left")), F.signum("_left")).otherwise(0) for k in turns)
    copies = F.floor(F.col("taken") / F.col("size")) + F.when(cut & F.col("_more"), 1).otherwise(0) + moved
    return told.withColumns({"_whole": whole, "copies": F.when(F.col("size") > 0, copies).otherwise(1).cast("int")})


def along() -> Window:
    """A slice's documents in seeded order, up to the current one."""
    return Window.partitionBy("_source", "_slice").orderBy("_draw", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)


def _plain(carried: Sequence[str]) -> list[str]:
    return [c for c in carried if c not in MADE]


def _mixed(docs: DataFrame, plain: list[str], block: int, slices: int, seed: int, repeats: int, weights: int, size: Column | None) -> DataFrame:
    """The ``plain`` columns with those of MADE and, for further steps, source, slice, order and the source's documents with words."""
    rows = keep_table(_rows(docs, plain, slices, seed, size), "mix-rows")
    pieces = keep_table(rows.groupBy("_source", "_piece").agg(F.sum("size").alias("piece_size"), F.count_if(F.col("size") > 0).alias("_docs")), "mix-slices")
    return _placed(rows, pieces, plain, block, slices, repeats, weights)


def _rows(docs: DataFrame, plain: list[str], slices: int, seed: int, size: Column | None) -> DataFrame:
    """The ``plain`` columns with size, source, piece of it and place on its tape."""
    size = word_count("text") if size is None else size
    rows = docs.select(*plain, F.col("doc_id").alias("_id"), size.alias("size"),
                       # A struct keeps NULL a source of its own, after all names.
                       F.struct(F.col("source").isNull().alias("missing"), F.coalesce("source", F.lit("")).alias("name")).alias("_source"),
                       F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_draw"))
    return rows.withColumn("_piece", F.pmod(F.col("_draw"), F.lit(slices)))


def _placed(rows: DataFrame, pieces: DataFrame, plain: list[str], block: int, slices: int, repeats: int, weights: int) -> DataFrame:
    sources = pieces.groupBy("_source").agg(F.sum("piece_size").alias("source_size"), F.sum("_docs").alias("_docs"))
    ranked = gapless_rank(sources, [F.col("_source")], "_place", "mix-sources")
    weighed = keep_table(ranked.select("_source", "source_size", "_docs", (F.col("_place") % weights + 1).alias("weight")), "mix-weights")
    targets = keep_table(apportioned_sources(water_filled(weighed, repeats), block), "mix-targets")
    full = F.least(F.col("_docs"), F.floor(F.col("source_size") / block)) / LEAST_IN_SLICE
    own = F.greatest(F.lit(1), F.least(F.lit(slices), F.floor(full))).cast("long")
    known = ["seats", "source_size", "target", "_docs"]
    pieces = (pieces.drop("_docs").join(targets.select("_source", *known), "_source")
              .withColumn("_slice", F.floor(F.col("_piece") * own / slices)))
    quotas = apportioned_slices(pieces.groupBy("_source", "_slice", *known).agg(F.sum("piece_size").alias("slice_size")))
    words = F.least(F.col("quota") * block, repeats * F.col("slice_size"))
    lines = pieces.select("_source", "_piece", "_slice").join(
        quotas.select("_source", "_slice", "slice_size", "source_size", "target", "_docs", words.alias("_words")), ["_source", "_slice"])
    placed = rows.join(lines, ["_source", "_piece"]).withColumn("_end", F.sum("size").over(along()))
    rounds = F.when(F.col("slice_size") > 0, F.floor(F.col("_words") / F.col("slice_size"))).otherwise(0).cast("long")
    rest = F.col("_words") - rounds * F.col("slice_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("_end") - F.col("size"))))
    return placed.select(*plain, "size", "source_size", "target", (rounds * F.col("size") + part).cast("long").alias("taken"),
                         "_source", "_piece", "_slice", "_draw", "_id", "_docs")
