"""Character references of link titles and addresses, against the standard library's reading."""

import html

from pyspark.sql import functions as F

from attestry.operators.discover import unescape

TEXTS = [
    "plain", "a & b", "&", "&&amp;&", "&amp;lt;", "&lt;b&gt;", "&quot;x&quot;", "&#39;&#039;", "&#x27;&#X2F;", "&nbsp;", "&eacute;t&eacute;",
    "&eacutet", "&copy2020", "&copy;", "&notin;", "&notit;", "&notX", "&CounterClockwiseContourIntegral;", "&unknown;", "&;", "&#;", "&#x;",
    "&#8364;", "&#128;", "&#129;", "&#150;x", "&#0;", "&#xD800;", "&#x110000;", "&#99999999999999999999;", "&#x1F600;", "&#11;", "&#xFFFF;",
    "&#13;", "&amp", "&ampx", "&AMP;", "&NotEqualTilde;", "a&b=1&copy=2", "&hellip;&ndash;&mdash;", "?a=1&amp;b=2", "&#x00000041;", "",
]


def test_references_are_read_as_html_reads_them(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    got = {r.t: r.u for r in df.select("t", unescape(F.col("t")).alias("u")).collect()}
    assert got.pop(None) is None
    assert {t: u for t, u in got.items() if u != html.unescape(t)} == {}
