"""Golden values for the column functions (text, dates, urls, escape)."""
import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from vigia.functions import dates as D
from vigia.functions import text as TX
from vigia.functions.urls import _resolved, absolute_url


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first().r


BASE = "https://h.org/p/q/r"
URLS = {
    "/a/b.pdf": "https://h.org/a/b.pdf", "b.pdf": "https://h.org/p/q/b.pdf", "../x.pdf": "https://h.org/p/x.pdf",
    "http://o/x": "http://o/x", "//cdn/x.pdf": "https://cdn/x.pdf", "?q=1": "https://h.org/p/q/r?q=1",
    "#f": "https://h.org/p/q/r#f", "": BASE, "./y.pdf": "https://h.org/p/q/y.pdf",
    "a/../b.pdf?x=/../1": "https://h.org/p/q/b.pdf?x=/../1", "../../../z": "https://h.org/z",
}


def test_absolute_url_goldens(spark):
    rows = [(BASE, k) for k in URLS] + [(BASE, None)]
    got = spark.createDataFrame(rows, "b string, l string").select("l", absolute_url("b", "l").alias("u")).collect()
    for r in got:
        assert r.u == (BASE if r.l is None else URLS[r.l]), r


def test_absolute_url_matches_stdlib(spark):
    bases = ["http://x.example.com/fr/825?page=2&ref=x", "https://m.y.example.net/en/25#top", "https://www.agemed.gob.bo/"]
    links = ["a//b/./c/..", "..", ".", "/a/../b/./c", "HTTPS://X.org/a", "archivo/1.pdf", "?", "a?b#c", "//cdn", "/erüver"]
    df = spark.createDataFrame([(b, l) for b in bases for l in links], "b string, l string")
    for r in df.select("b", "l", absolute_url("b", "l").alias("u")).collect():
        assert r.u == urljoin(r.b, r.l), r


def test_strip_and_collapse_unicode_whitespace(spark):
    s = " \t a 　 b\n "
    assert one(spark, TX.strip_ws, s) == s.strip()
    assert one(spark, TX.collapse_ws, s) == " ".join(s.split())
    assert one(spark, TX.collapse_ws, " ".join(s.split())) == " ".join(s.split())   # idempotent


def test_html_escape(spark):
    assert one(spark, TX.html_escape, "a<b>&\"'") == "a&lt;b&gt;&amp;&quot;&#x27;"


def test_title_costarica(spark):
    cases = {
        "5 DE MARZO de 2025- Alerta": "Alerta", "5 de marzo de 2025. Alerta X": "Alerta x",
        "5 de marzo Alerta": "Alerta", "12 de setiembre. Alerta": "12 de setiembre. alerta",
        "5 de marzo de 2025": "", "ÁRBOL verde ROJO": "Árbol verde rojo", "1ABC": "1abc",
    }
    for raw, want in cases.items():
        assert one(spark, TX.clean_title_costarica, raw) == want, raw


def test_title_mexico(spark):
    assert one(spark, TX.clean_title_mexico, "A_05112025.pdf") == "A"
    assert one(spark, TX.clean_title_mexico, "_ A 05112025 _") == "A"
    assert one(spark, TX.clean_title_mexico, "sin fecha.pdf x") == "sin fecha"


def test_date_policies(spark):
    def fecha(raw, src, fallback=None):
        df = spark.createDataFrame([(raw,)], "v string")
        _, f, _ = D.apply_policy(F.col("v"), D.POLICIES[src], raw_fallback=None if fallback is None else F.lit(fallback))
        return df.select(f.alias("f")).first().f
    assert fecha("1/2/2025 9:05", "brasil") == "01-02-2025 09:05"
    assert fecha("31/02/2025 10:00", "brasil", "31/02/2025") == "31/02/2025"
    assert fecha("01/02/2025  09:05", "brasil") == "01-02-2025 09:05"
    assert fecha("05112025", "mexico") == "05-11-2025"
    assert fecha("32112025", "mexico") == "32112025"
    assert fecha("20251105", "mexico") == "20251105"
    assert fecha(None, "mexico") == "Sin Fecha"
    assert fecha("2025-1-5", "colombia") == "05-01-2025"
    assert fecha("2025-11-05 10:00:00", "argentina") == "05-11-2025 10:00"
    assert fecha("2025-11-05T10:00:00", "costarica") == "2025-11-05T10:00:00"
    assert fecha("1/12/25", "bolivia") is None
    assert fecha("Thu, 20 Nov 2025 10:05:00 -0500", "peru") == "20-11-2025 15:05:00"
    assert fecha("not a date", "chile") == "Sin Fecha"


def test_report_date(spark):
    df = spark.createDataFrame([("20-11-2025 10:00",), ("Sin Fecha",), ("2025-12-05",)], "f string")
    got = [r.d for r in df.select(D.report_date("f").alias("d")).collect()]
    assert str(got[0]) == "2025-11-20" and got[1] is None and got[2] is None


def test_lead_words(spark):
    text = " ".join(f"w{i}" for i in range(40))
    assert one(spark, lambda c: TX.lead_words(c, 30), "  " + text) == " ".join(f"w{i}" for i in range(30))


def test_random_links_match_stdlib(spark):
    rng, bits = random.Random(5), ["a", "b.pdf", "/", "//", ".", "..", "./", "../", "?", "?q=1", "#", "#f", ":", "http:", "https://h", "http://o/", " ", "%20", "ñ", "\t", "\n", "-"]
    bases = ["https://a.org", "https://a.org/", "https://a.org/d/p.html", "http://a.org/d/e/", "https://a.org/d//e/f", "https://a.org/d/./e", "https://a.org/d?x=1", "https://a.org/d/e#z", "HTTPS://a.org/x"]
    rows = [(rng.choice(bases), "".join(rng.choice(bits) for _ in range(rng.randrange(1, 6)))) for _ in range(4000)]
    df = spark.createDataFrame(rows, "b string, l string")
    for r in df.select("b", "l", absolute_url("b", "l").alias("u"), _resolved(F.col("b"), F.col("l")).alias("slow")).collect():
        assert r.u == r.slow, r


def test_feed_dates_of_short_years_and_iso(spark):
    rows = [("Tue, 05 Mar 24 10:20:30 +0000", "2024-03-05 10:20:30"), ("5 Mar 99 10:20 GMT", "1999-03-05 10:20:00"), ("05 Mar 68 00:00:00 -0300", "2068-03-05 03:00:00"),
            ("2024-03-05T10:20:30Z", "2024-03-05 10:20:30"), ("2024-03-05T10:20:30.5-05:00", "2024-03-05 15:20:30.5"), ("2024-03-05", "2024-03-05 00:00:00"),
            ("2024-03-05 10:20:30", "2024-03-05 10:20:30"), ("Tue, 05 Mar 2024 10:20:30 +0000", "2024-03-05 10:20:30"), ("2024", None), ("05/03/2024", None), ("2024-13-05", None), ("", None), (None, None)]
    got = spark.createDataFrame(rows, "s string, want string").select("s", "want", D.feed_ts("s").cast("string").alias("got")).collect()
    assert [(r.s, r.got) for r in got] == rows


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from vigia.session import checkpoint_dir
    fake = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_dir(fake(master))
