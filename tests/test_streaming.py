"""The article preparation on a file stream equals the batch result."""

import os
import tempfile

from fixtures import ARTICLE_URLS, write_articles

from titlematch.plans.prepare import prepare_articles
from titlematch.sources import read_articles
from titlematch.streaming import article_stream


def test_article_stream_matches_batch(spark, workdir):
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    write_articles(src, name="a.xml")
    sdf = article_stream(spark, src)
    assert sdf.isStreaming
    q = (
        sdf.writeStream.format("memory")
        .queryName("articles_stream_test")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="tm-stream-", dir="/tmp"))
        .start()
    )
    try:
        q.processAllAvailable()
        got = sorted(map(tuple, spark.sql("SELECT * FROM articles_stream_test").collect()))
    finally:
        q.stop()
    batch = sorted(map(tuple, prepare_articles(read_articles(spark, src)).collect()))
    assert got == batch and len(got) == len(ARTICLE_URLS)
