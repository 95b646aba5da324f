"""Extractive summaries against a plain twin, and through a run."""
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from vigia.operators import content as C
from vigia.operators.summary import extractive_summaries, with_summaries
from vigia.plans import job
from vigia.sources import rules as RU
from vigia.sources.alert_store import AlertStore
from vigia.sources.content_store import PlainContent


def units(text, longest=30):
    out = []
    for s in re.sub(r"([.!?…]) ", "\\1\n", " ".join(text.split())).split("\n"):
        w = s.split(" ")
        out += [w[i:i + longest] for i in range(0, len(w), longest)]
    return [u for u in out if u != [""]]


def terms(unit):
    return re.findall(r"[^\W_]+", " ".join(unit).lower())


def plain(rows, least=20, longest=30, candidates=12):
    cut = {k: units(t, longest) for k, t in rows if t and t.split()}
    tf = {k: {} for k in cut}
    for k, us in cut.items():
        for u in us:
            for t in terms(u):
                tf[k][t] = tf[k].get(t, 0) + 1
    df = {}
    for k in tf:
        for t in tf[k]:
            df[t] = df.get(t, 0) + 1
    out = {}
    for k, us in cut.items():
        weight = {t: math.floor(1000.0 * (1 + math.log(n)) * math.log((len(cut) + 1.0) / df[t])) for t, n in tf[k].items()}
        gain = lambda i, seen: sum(weight[t] for t in set(terms(us[i])) - seen) // (len(us[i]) + 5)
        left = sorted((i for i in range(len(us)) if terms(us[i])), key=lambda i: (-gain(i, set()), i))[:candidates]
        chosen, seen, n = [], set(), 0
        while n < least:
            fit = [i for i in left if i not in chosen and n + len(us[i]) <= longest]
            best = max(fit, key=lambda i: (gain(i, seen), -i), default=None)
            if best is None or gain(best, seen) <= 0:
                break
            chosen.append(best)
            seen |= set(terms(us[best]))
            n += len(us[best])
        if chosen:
            out[k] = " ".join(" ".join(us[i]) for i in sorted(chosen))
    return out


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "content_key string, content string").withColumn("pos", F.lit("x")).withColumn("n", F.lit(None).cast("string"))
    return {r.content_key: r.summary for r in extractive_summaries(df, **how).collect()}


def corpus(n=40):
    rng, words = random.Random(9), [f"palabra{i}" for i in range(60)] + ["de", "la", "ñandú", "3", "x-y"]
    return [(f"k{i}", " ".join(" ".join(rng.choices(words, k=rng.randrange(1, 16))) + rng.choice([".", ".", "!", "?", "…", ",", ""]) for _ in range(rng.randrange(1, 25)))) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"min_words": 5, "max_words": 8, "candidates": 4}])
def test_against_a_plain_twin(spark, how):
    rows = corpus()
    got = run(spark, rows, **how)
    assert got == plain(rows, how.get("min_words", 20), how.get("max_words", 30), how.get("candidates", 12)) and len(got) == 40
    assert all(len(s.split()) <= how.get("max_words", 30) for s in got.values())


def test_edge_texts(spark):
    rows = [("null", None), ("empty", ""), ("blank", " \t\n "), ("marks", "... !!! ?"), ("one", "Hola."), ("long", "uno dos " * 5000), ("same", "Hola."), ("tabs", "a\tb.\n c  d!")]
    got = run(spark, [*rows, (None, "sin clave")])
    assert got == plain(rows) and set(got) == {"one", "long", "same", "tabs"} and len(got["long"].split()) <= 30
    assert run(spark, []) == {}


def test_blocks_weigh_alike(spark):
    rows = [*corpus(), ("long", "uno dos " * 300), ("one", "Hola.")]
    assert run(spark, rows, block_chars=400) == run(spark, rows, block_chars=10**9) == plain(rows)


def test_texts_of_one_key_are_one_text(spark):
    rows = [*corpus(6), ("a", "Uno dos tres. Cuatro cinco."), ("a", "Uno dos tres. Cuatro cinco."), ("a", " ")]
    merged = [*corpus(6), ("a", "Uno dos tres. Uno dos tres. Cuatro cinco. Cuatro cinco.")]
    assert run(spark, rows, block_chars=400) == run(spark, merged) == plain(merged)


def test_no_row_a_text_and_term_moves(spark):
    df = spark.createDataFrame(corpus(), "content_key string, content string")
    plan = extractive_summaries(df, block_chars=400)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.split("\n") if "Exchange" in line]
    assert len(dealt) == 3 and sum("hashpartitioning(_b#" in x for x in dealt) == 2 and sum("hashpartitioning(term#" in x for x in dealt) == 1
    assert "Join" not in plan


def test_a_repeated_sentence_comes_last(spark):
    text = "Retiro del lote siete del jarabe. Retiro del lote siete del jarabe. Consulte la farmacia mas cercana hoy."
    assert run(spark, [("a", text), ("b", "Otra cosa.")])["a"] == "Retiro del lote siete del jarabe. Consulte la farmacia mas cercana hoy."


def test_summaries_in_a_run(spark, scratch):
    news = spark.createDataFrame([("u", None, "t", "f", "Argentina", "i"), ("v", None, "sin texto", "f", "Argentina", "i")], "url string, pdf string, titulo string, fecha string, pais string, institucion string")
    web = spark.createDataFrame([("u", "<div class='news__lead'><p>Primera frase corta. Segunda frase larga con detalle. Primera frase corta.</p></div>")], "url string, html string")
    store = AlertStore(spark, scratch)
    job.run_on(store, news, PlainContent(web, spark.createDataFrame([], "url string, page_no int, text string")), RU.rules_from_dict(spark, RU.COUNTRY_RULES), extractive=True)
    got = {r.url: r.resumen for r in store.history().collect()}
    assert got == {"u": "Primera frase corta. Segunda frase larga con detalle.", "v": "sin texto"}


def test_a_content_table_brings_its_summaries(spark):
    texts = spark.createDataFrame([("k", "Uno dos tres. Cuatro.")], "content_key string, content string")
    news = spark.createDataFrame([("u", "k", "T"), ("w", "none", "W")], "url string, content_key string, titulo string")
    assert {r.url: r.resumen for r in C.enrich(news, with_summaries(texts)).collect()} == {"u": "Uno dos tres. Cuatro.", "w": "W"}
