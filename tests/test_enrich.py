"""A vectorised summariser plugged into enrichment, with the title fallback."""
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from vigia.operators import content as C


def _first_sentence(text: pd.Series, title: pd.Series) -> pd.Series:
    # a stand-in for a model call: rows without text (no content joined) get no answer
    return text.map(lambda t: None if t is None else t.split(".")[0].strip())


def test_pandas_udf_summariser_and_fallback(spark):
    news = spark.createDataFrame(
        [("u1", "k1", "T1"), ("u2", "k2", "T2"), ("u3", "missing", "T3"), ("u4", "k4", "T4")],
        "url string, content_key string, titulo string")
    content = spark.createDataFrame(
        [("k1", "Primera frase. Segunda."), ("k2", "   . resto"), ("k4", None)], "content_key string, content string")
    first_sentence = pandas_udf(_first_sentence, StringType())
    out = {r.url: r.resumen for r in C.enrich(news, content, summariser=first_sentence).collect()}
    # an answer, a blank answer (title), no content row (title), null content (title)
    assert out == {"u1": "Primera frase", "u2": "T2", "u3": "T3", "u4": "T4"}


def test_default_summariser_is_native(spark):
    news = spark.createDataFrame([("u1", "k1", "T1")], "url string, content_key string, titulo string")
    content = spark.createDataFrame([("k1", " ".join(f"w{i}" for i in range(40)))], "content_key string, content string")
    df = C.enrich(news, content)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert df.collect()[0].resumen == " ".join(f"w{i}" for i in range(30))
