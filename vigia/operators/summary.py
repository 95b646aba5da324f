"""Extractive summaries of 20 to 30 words, one grouped job over a table of texts.

* A text is cut into units: its sentences, those of more than ``max_words`` words in runs of that
  many. Terms are runs of letters and digits, in lower case.
* A term weighs ``1000 (1 + ln tf) ln((N + 1) / df)`` in a text, rounded down: ``tf`` its count in
  the text, ``df`` the texts that hold it, ``N`` all texts. Both counts are distributed; nothing
  of the vocabulary is collected. Texts are dealt into blocks by their key: what moves is whole
  texts and, once a block, its different terms with their counts, never a row a text and term.
* Units are chosen one by one: the one whose terms not yet covered weigh most for its length
  (sum over words + 5, ties to the earlier) among those that still fit. What a chosen unit says
  counts no more, so a sentence that repeats it comes last. It ends at ``min_words`` words, or
  when nothing more fits or adds. The choice is among the ``candidates`` best units of a text.
* The chosen units, in the order of the text, are the summary; a text without a term has none.

Weights and gains are whole numbers, so the result does not depend on the order of any sum.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse_ws
from ..session import checkpoint_dir

TERM = r"[\p{L}\p{N}]+"
MIN_WORDS, MAX_WORDS, CANDIDATES = 20, 30, 12
#: Characters of texts to a block, on average: its terms are counted and weighed in one task.
BLOCK_CHARS = 2_000_000

#: One choice after another: ``s`` is what was chosen so far, ``b`` the best unit left.
_CHOICE = """aggregate(sequence(1, {max_words}),
    named_struct('n', 0, 'seen', CAST(array() AS array<string>), 'chosen', CAST(array() AS array<struct<pos:int,unit:string>>), 'done', false),
    (s, i) -> CASE WHEN s.done THEN s ELSE aggregate(
        array(array_max(transform(filter(units, u -> s.n + u.n <= {max_words} AND NOT exists(s.chosen, h -> h.pos = u.pos)), u -> named_struct(
            'gain', aggregate(filter(u.terms, x -> NOT array_contains(s.seen, x.term)), 0L, (a, x) -> a + x.weight) div (u.n + 5),
            'before', -u.pos, 'n', u.n, 'unit', u.unit, 'terms', transform(u.terms, x -> x.term))))),
        s, (t, b) -> CASE WHEN b IS NULL OR b.gain <= 0 THEN named_struct('n', t.n, 'seen', t.seen, 'chosen', t.chosen, 'done', true)
            ELSE named_struct('n', t.n + b.n, 'seen', array_union(t.seen, b.terms),
                'chosen', array_append(t.chosen, named_struct('pos', -b.before, 'unit', b.unit)), 'done', t.n + b.n >= {min_words}) END) END).chosen"""


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession)}/vigia-summary/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_units(flat: Column, max_words: int = MAX_WORDS) -> Column:
    """The units of a collapsed text in order: its sentence's place, the first word's place in it, words."""
    sentences = F.split(F.regexp_replace(flat, r"([.!?…]) ", "$1\n"), "\n")
    words = F.transform(sentences, lambda s: F.split(s, " "))
    return F.flatten(F.transform(words, lambda w, i: F.transform(
        F.sequence(F.lit(0), F.size(w) - 1, F.lit(max_words)), lambda c: F.struct(i.alias("s"), c.alias("c"), F.slice(w, c + 1, max_words).alias("words")))))


def _dealt_units(rows: DataFrame, key: str, max_words: int, blocks: int) -> DataFrame:
    """``_b, key, at, known``: whole blocks to a task, in it the units of each key (texts that share one are
    one text, their units in the order of the sentences) and, without key, what is known of the block's terms."""
    known = F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "df")))
    grouped = rows.repartition(blocks, "_b").groupBy("_b", key).agg(F.collect_list("flat").alias("_texts"), known.alias("known"))
    units = F.flatten(F.transform("_texts", lambda t: text_units(t, max_words)))
    return grouped.select("_b", key, F.when(F.size("_texts") > 1, F.array_sort(units)).otherwise(units).alias("at"), "known")


def _terms(unit: Column) -> Column:
    return F.regexp_extract_all(F.lower(unit), F.lit(TERM), F.lit(0))


def _row(*values: Column | None) -> Column:
    fields = zip(values, ("pos", "n", "unit", "term", "df"), ("int", "int", "string", "string", "long"), strict=True)
    return F.struct(*((F.lit(None) if v is None else v).cast(kind).alias(name) for v, name, kind in fields))


def extractive_summaries(texts: DataFrame, key: str = "content_key", text: str = "content", *, min_words: int = MIN_WORDS,
                         max_words: int = MAX_WORDS, candidates: int = CANDIDATES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``key, summary`` of each text of ``texts`` (one row a key); texts without a term have no row."""
    flat = texts.where(F.col(key).isNotNull()).select(key, collapse_ws(F.col(text)).alias("flat"))
    flat = _stored(flat.where(F.col("flat") != ""), "texts")
    total, chars = flat.agg(F.count_distinct(key), F.coalesce(F.sum(F.length("flat").cast("long")), F.lit(0))).first()
    blocks = chars // block_chars + 1
    flat = flat.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_b"), key, "flat", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("df"))

    # a block's terms leave it with the number of texts in it, and come back with that of all texts
    in_text = F.array_distinct(F.flatten(F.transform("at", lambda u: _terms(F.array_join(u["words"], " ")))))
    held = _dealt_units(flat, key, max_words, blocks).select("_b", F.explode(in_text).alias("term"))
    held = held.groupBy("_b", "term").agg(F.count("*").alias("n"))
    known = held.select("_b", "term", F.sum("n").over(Window.partitionBy("term")).alias("df"))
    rows = _dealt_units(flat.unionByName(known, allowMissingColumns=True), key, max_words, blocks)

    # one row a unit, one a term in it, one a known term (without key); all that follows stays in the block's task
    units = F.transform("at", lambda u, i: _row(i, F.size(u["words"]), F.array_join(u["words"], " "), None, None))
    rows = rows.select("_b", key, F.inline(F.concat(units, F.transform("known", lambda t: _row(None, None, None, t["term"], t["df"])))))
    held = F.when(F.col("unit").isNull(), F.array("term")).otherwise(F.concat(F.array(F.lit(None).cast("string")), _terms(F.col("unit"))))
    rows = rows.select("_b", key, "pos", "n", "unit", "df", F.explode(held).alias("term")).withColumn("unit", F.when(F.col("term").isNull(), F.col("unit")))
    everywhere = Window.partitionBy("_b", "term").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("df", F.max("df").over(everywhere)).withColumn("tf", F.count("*").over(Window.partitionBy("_b", "term", key)))
    weight = F.floor(1000.0 * (1 + F.log("tf")) * F.log(F.lit(total + 1.0) / F.col("df"))).cast("long")
    said = rows.where(F.col(key).isNotNull()).groupBy("_b", key, "pos").agg(
        F.max("n").alias("n"), F.max("unit").alias("unit"), F.collect_set(F.when(F.col("term").isNotNull(), F.struct("term", weight.alias("weight")))).alias("terms"))
    ranked = said.where(F.size("terms") > 0).withColumn("sum", F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + t["weight"]))
    best = F.row_number().over(Window.partitionBy("_b", key).orderBy(F.expr("sum div (n + 5)").desc(), "pos"))
    ranked = ranked.withColumn("_rank", best).where(F.col("_rank") <= candidates)
    lists = ranked.groupBy("_b", key).agg(F.collect_list(F.struct("pos", "n", "unit", "terms")).alias("units"))
    chosen = F.expr(_CHOICE.format(min_words=min_words, max_words=max_words))
    out = lists.select(key, F.array_sort(chosen).alias("chosen"))
    return out.where(F.size("chosen") > 0).select(key, F.array_join(F.transform("chosen", lambda c: c["unit"]), " ").alias("summary"))


def with_summaries(texts: DataFrame, key: str = "content_key", text: str = "content") -> DataFrame:
    """``texts`` with a column ``summary`` (null where there is none), as ``enrich`` takes it."""
    return texts.join(extractive_summaries(texts, key, text), key, "left")
