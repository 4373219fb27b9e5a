"""Operator 10: personal data, and terms whose co-occurrence discloses it, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import keep_table, let, table

# The kinds in their order, with patterns that match what the plain ones match.  Runs are
# possessive, and an email starts where a run of its characters starts or the last match ended, so no
# text is walked twice.
KINDS = {"email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         "card": r"[0-9](?:[\x20-]?[0-9])++",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
# What a text must contain for the kind to be looked for at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_IN_RANGE = rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CONTEXT = 80
GENERALISE, REMOVE = 0.8, 0.95
_STEP = 256


def prefix_sums(values: Column) -> Column:
    """Running totals, by sums of pieces, so that long arrays stay far from quadratic work."""
    def add(piece: Column) -> Column:
        return F.aggregate(piece, F.lit(0).cast("long"), lambda a, x: a + x)

    def within(v: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _STEP).cast("int") * (F.size(v) > 0).cast("int")),
                             lambda b: add(F.slice(v, b * _STEP + 1, F.lit(_STEP))))
        return let(pieces, lambda p: let(
            F.transform(p, lambda _, i: add(F.slice(p, F.lit(1), i))),
            lambda before: F.transform(v, lambda _, i: F.element_at(before, F.floor(i / _STEP).cast("int") + 1)
                                       + add(F.slice(v, F.floor(i / _STEP).cast("int") * _STEP + 1, i % _STEP + 1)))))

    return let(F.transform(values, lambda x: x.cast("long")), within)


def located(text: Column, pattern: str) -> Column:
    """Every match as (value, start, end) in code points: matches, and the text between them, by length."""
    def place(both: Column) -> Column:
        gaps, hits = both["gaps"], both["hits"]
        ends = prefix_sums(F.transform(hits, lambda h, i: F.length(F.element_at(gaps, i + 1)) + F.length(h)))
        return let(ends, lambda e: F.transform(hits, lambda h, i: F.struct(
            h.alias("value"), (F.element_at(e, i + 1) - F.length(h)).alias("start"), F.element_at(e, i + 1).alias("end"))))

    return let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")), place)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, doubled).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), weighed), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


VALID = {"email": lambda v: F.lit(True), "ip": lambda v: v.rlike(IP_IN_RANGE),
         "card": lambda v: let(_digits(v), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False)),
         "phone": lambda v: F.length(_digits(v)).between(10, 15)}
NORMAL = {"email": F.lower, "ip": lambda v: v, "card": _digits, "phone": _digits}
# What an entity belongs to: the domain, the network, the issuer, the area.
BROADER = {"email": lambda v: F.substring_index(F.lower(v), "@", -1), "ip": lambda v: F.substring_index(v, ".", 3),
           "card": lambda v: F.substring(_digits(v), 1, 6), "phone": lambda v: F.substring(_digits(v), 1, 5)}
_SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,entity:bigint,broader:bigint>>"


def spans_of(text: Column, kind: str, rank: int) -> Column:
    """The valid spans of one kind; the hint spares texts without it the search."""
    found = F.filter(located(text, KINDS[kind]), lambda m: VALID[kind](m["value"]))
    spans = F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"),
        F.xxhash64(F.lit(kind), NORMAL[kind](m["value"])).alias("entity"), F.xxhash64(F.lit(f"{kind} of"), BROADER[kind](m["value"])).alias("broader")))
    hint = text.contains("@") if kind == "email" else text.rlike(HINTS[kind])
    return F.when(hint, spans).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """All valid spans of all kinds, by start, then kind as listed."""
    return F.array_sort(F.concat(*[spans_of(text, kind, rank) for rank, kind in enumerate(KINDS)]))


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def contexts(text: Column, spans: Column) -> Column:
    """Per mention its entity and the text on both sides, up to CONTEXT code points or the next mention."""
    def around(s: Column, i: Column) -> Column:
        earlier = F.slice(spans, F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3)))
        floor = F.aggregate(earlier, F.lit(0).cast("long"), lambda a, x: F.greatest(a, x["end"]))
        left = F.least(F.greatest(floor, s["start"] - CONTEXT), s["start"])
        after = F.when(i + 1 < F.size(spans), F.element_at(spans, F.least(i + 2, F.size(spans)))["start"]).otherwise(F.length(text))
        right = F.greatest(F.least(after, s["end"] + CONTEXT), s["end"])
        side = [F.struct(s["entity"].alias("entity"), s["broader"].alias("broader"), F.substring(text, (at + 1).cast("int"), (to - at).cast("int")).alias("piece"), at.alias("at"),
                         first.alias("cut_first"), last.alias("cut_last"))
                for at, to, first, last in ((left, s["start"], left > floor, F.lit(False)), (s["end"], right, F.lit(False), right < after))]
        return F.array(*side)

    return F.flatten(F.transform(spans, around))


def context_terms(rows: DataFrame) -> DataFrame:
    """(content, entity, term) of every whole word near a mention, for the entity and for what it belongs to."""
    pieces = (rows.where(F.size("sides") > 0).select("content", F.explode("sides").alias("side"))
              .select("content", "side.*").where(F.length("piece") > 0))
    found = pieces.select("content", "entity", "broader", "cut_first", "cut_last", F.length("piece").alias("size"),
                          F.explode(located(F.col("piece"), TERM)).alias("t"))
    whole = ~((F.col("cut_first") & (F.col("t.start") == 0)) | (F.col("cut_last") & (F.col("t.end") == F.col("size"))))
    return found.where(whole & (F.length("t.value") > 1)).select(
        "content", F.explode(F.array("entity", "broader")).alias("entity"), F.xxhash64(F.lower("t.value")).alias("term"))


def terms_of(text: Column) -> Column:
    """The distinct terms of a text, however far they stand from anything."""
    return F.transform(F.filter(F.array_distinct(F.split(F.lower(text), BREAKS)), lambda w: F.length(w) > 1), lambda w: F.xxhash64(w))


def disclosed_terms(text: Column, spans: Column, removed: Column, generalised: Column) -> Column:
    """Every occurrence of the given terms between the base spans of the whole text, as (start, end, action)."""
    def between(i: Column) -> Column:
        # Spans of one kind do not overlap, so the last ones of all kinds tell where the text goes on.
        at = F.aggregate(F.slice(spans, F.greatest(i - len(KINDS) + 1, F.lit(1)), F.least(i, F.lit(len(KINDS)))), F.lit(0).cast("long"),
                         lambda a, x: F.greatest(a, x["end"]))
        to = F.when(i < F.size(spans), F.element_at(spans, F.least(i + 1, F.size(spans)))["start"]).otherwise(F.length(text))
        return F.struct(at.alias("at"), F.substring(text, (at + 1).cast("int"), F.greatest(to - at, F.lit(0)).cast("int")).alias("piece"))

    def marked(gap: Column) -> Column:
        words = F.transform(F.filter(located(gap["piece"], TERM), lambda t: F.length(t["value"]) > 1), lambda t: let(
            F.xxhash64(F.lower(t["value"])), lambda term: F.struct(
                (gap["at"] + t["start"]).alias("start"), (gap["at"] + t["end"]).alias("end"),
                F.when(F.array_contains(removed, term), "remove").when(F.array_contains(generalised, term), "generalise").alias("action"))))
        return F.filter(words, lambda w: w["action"].isNotNull())

    return F.flatten(F.transform(F.transform(F.sequence(F.lit(0), F.size(spans)), between), marked))


def shares(pairs: DataFrame, entities: DataFrame, terms: DataFrame, total: float) -> DataFrame:
    """(entity, term, share): the pointwise information PMI(entity; term) = log2(n(e,t) N / (n(e) n(t))) as a share of the
    entity's own information IC = log2(N / n(e)).  A pair that only one text has gives no estimate."""
    # Words that lie near several mentions of one entity can be counted more often than they occur.
    known = pairs.where("low < high").join(terms, "term").join(entities, "entity").withColumn("n_pair", F.least("n_pair", "n_term"))
    own = F.log2(F.lit(float(total)) / F.col("n_entity"))
    shared = F.log2(F.col("n_pair") * float(total) / (F.col("n_entity").cast("double") * F.col("n_term")))
    return known.select("entity", "term", F.when(own > 0, shared / own).otherwise(F.lit(0.0)).alias("share"))


def disclosing(occurrences: DataFrame, mentions: DataFrame, rows: DataFrame, docs: DataFrame, generalise: float, remove: float) -> DataFrame:
    """(entity, term, action) of the terms that reveal an entity, or what it belongs to.

    Two estimates over the whole corpus, of which the higher counts.  Near: n(e,t) counts the term near the
    entity, n(e) all words near it, n(t) the term anywhere, N all words.  Far: the same in texts that have the term,
    the entity or both, wherever they stand.  At the share ``generalise`` of an entity's information a term is
    generalised, at ``remove`` it is removed.

    An entity that one text alone mentions has no estimate of its own: what is known of it is backed off to what it
    belongs to (a domain, network, issuer or area), an entity like others that more texts mention.
    """
    def told(pairs: DataFrame, rows: Column) -> DataFrame:
        return pairs.groupBy("entity", "term").agg(F.sum(rows).alias("n_pair"), F.min("content").alias("low"), F.max("content").alias("high"))

    one = F.lit(1)
    words = (docs.select(F.explode(F.split(F.lower("text"), BREAKS)).alias("w")).where(F.length("w") > 1)
             .groupBy(F.xxhash64("w").alias("term")).agg(F.count(one).alias("n_term")))
    words = keep_table(words, "pii-words")
    near = shares(told(occurrences, one), occurrences.groupBy("entity").agg(F.count(one).alias("n_entity")), words,
                  words.agg(F.sum("n_term")).first()[0] or 1)

    texts = keep_table(docs.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count(one).alias("n_term")), "pii-texts")
    held = rows.where(F.size("spans") > 0).groupBy("content").agg(F.count(one).alias("times"), F.first("text").alias("text"))
    held = held.select("content", "times", F.explode(terms_of(F.col("text"))).alias("term"))
    both = held.join(mentions, "content")
    whole = mentions.join(rows.where(F.size("spans") > 0).groupBy("content").agg(F.count(one).alias("times")), "content")
    far = shares(told(both, F.col("times")), whole.groupBy("entity").agg(F.sum("times").alias("n_entity")), texts, docs.count() or 1)
    share = near.unionByName(far).groupBy("entity", "term").agg(F.max("share").alias("share")).where(F.col("share") >= generalise)
    return share.select("entity", "term", F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action"))


def sanitise(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """doc_id, base (base spans) and added (term spans with their action), one row per document row.

    Base spans are the personal data found by pattern.  Added spans are the terms that disclose an entity or what
    it belongs to, judged by the words near its mentions and by the texts that mention it in the whole corpus,
    wherever they stand in a text that mentions it.  NULL and empty texts have no spans.  Rows with equal texts
    get equal spans; they count each in the corpus.  Rows with equal or NULL ids are separate rows.
    Further columns of the input are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("spans", base_spans(F.col("text")))
    # A one-row generate keeps the optimizer from computing the spans once for every later use.
    rows = rows.select("doc_id", F.explode(F.array(F.struct("text", "spans"))).alias("r")).select("doc_id", "r.text", "r.spans")
    none = F.array().cast("array<struct<entity:bigint,broader:bigint,piece:string,at:bigint,cut_first:boolean,cut_last:boolean>>")
    some = F.size("spans") > 0
    # Texts without mentions meet nobody: their key is their own id's.
    key = F.when(some, F.sha2("text", 256)).otherwise(F.concat(F.lit("#"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = keep_table(rows.select("doc_id", key.alias("content"), "spans", F.when(some, F.col("text")).alias("text"),
                                  F.when(some, contexts(F.col("text"), F.col("spans"))).otherwise(none).alias("sides")), "pii-rows")
    occurrences = keep_table(context_terms(rows), "pii-terms")
    mentions = F.array_distinct(F.concat(F.transform("spans", lambda s: s["entity"]), F.transform("spans", lambda s: s["broader"])))
    mentions = keep_table(rows.where(some).select("content", F.explode(mentions).alias("entity")).distinct(), "pii-mentions")
    known = disclosing(occurrences, mentions, rows, docs, generalise, remove)
    # A term may be removed for one entity and generalised for another: removal wins.
    wanted = (mentions.join(known, "entity").groupBy("content")
              .agg(F.collect_set(F.when(F.col("action") == "remove", F.col("term"))).alias("removed"),
                   F.collect_set(F.when(F.col("action") == "generalise", F.col("term"))).alias("generalised")))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,action:string>>")
    added = F.when(F.col("removed").isNotNull(), disclosed_terms(F.col("text"), F.col("spans"), F.col("removed"), F.col("generalised"))).otherwise(empty)
    return (rows.select("doc_id", "content", "spans", "text").join(wanted, "content", "left")
            .select("doc_id", F.col("spans").alias("base"), F.array_sort(added).alias("added")))


def rewritten(text: Column, base: Column, added: Column) -> Column:
    """The text with each base span as its kind in brackets, generalised terms as [TERM], removed ones gone."""
    marks = F.array_sort(F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by"))),
        F.transform(added, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["action"] == "remove", "").otherwise("[TERM]").alias("by")))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, m: Column) -> Column:
        between = F.substring(text, (acc["at"] + 1).cast("int"), (m["start"] - acc["at"]).cast("int"))
        return F.when(m["start"] < acc["at"], F.struct(F.greatest(acc["at"], m["end"]).alias("at"), acc["parts"].alias("parts"))).otherwise(
            F.struct(m["end"].alias("at"), F.concat(acc["parts"], F.array(between, m["by"])).alias("parts")))

    return F.aggregate(marks, start, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def op10_pii(spark, folder: str) -> DataFrame:
    found = sanitise(table(spark, folder, "documents"))
    named = F.transform("base", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    every = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))),
        F.transform("added", lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), t["end"].alias("end"), F.lit("term").alias("kind")))))
    return found.select("doc_id", *map(count_of, KINDS), F.sha2(F.array_join(named, ","), 256).alias("base_sha256"),
                        F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",").alias("spans"))
