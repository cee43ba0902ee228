"""Urls that end in the version word keep their captures, and come back unchanged."""

from distillery.llm.common import shared_folder, stored
from distillery.llm.warc import read_warc, transactions, write_warc


def test_url_ends_in_version_word(spark):
    urls = {1: "http://a/WARC/1.1", 2: "WARC/1.1", 3: "http://c/WARC%2F1.1", 4: "http://d/WARC/1.1?q", 5: None, 6: "http://e/WARC/1.1"}
    bodies = {k: "same " * 400 if k in (1, 4, 6) else f"body {k}" for k in urls}
    folder = shared_folder(spark)
    write_warc(spark.createDataFrame([(k, u, bodies[k]) for k, u in urls.items()], "page_id long, url string, html string"), folder)
    records = stored(read_warc(spark, folder))
    assert records.count() == 3 * len(urls) and records.filter("not complete").count() == 0
    got = transactions(records).select("page_id", "record_type", "payload_bytes", "refers_to", "response.target_uri",
                                       "request.target_uri").collect()
    revisits = (1, 4)  # of 6, the largest page_id with this payload; its url ends in the version word
    assert sorted(map(tuple, got)) == [
        (k, "revisit" if k in revisits else "response", len(bodies[k]), 6 if k in revisits else None, u, u) for k, u in urls.items()]
