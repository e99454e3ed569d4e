import datetime as dt
import hashlib
import json
import os

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postlake.plans.pages import build_postings, crawl_audit, extract_items, extract_with_config, load_crawler_config
from postlake.sources.bronze import scan_bronze, write_bronze
from postlake.sources.contract import apply_contract, load_contract, posting_contract
from postlake.sources.stream_io import read_stream
from postlake.streaming.ingest import ingest_stream


def _pandas_batch(path, records):
    # one flushed batch: a pandas frame from dicts, types inferred per batch
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pd.DataFrame(records).to_parquet(path, index=False, engine="pyarrow")


def test_scan_bronze_mixed_types(spark, tmp_dir):
    root = os.path.join(tmp_dir, "bronze")
    _pandas_batch(f"{root}/batch_date=2024-01-01/batch_hour=05/a.parquet",
                  [{"job_id": "1", "title": "t", "salary_min": 10, "tags": [], "experience_min": None}])
    _pandas_batch(f"{root}/batch_date=2024-01-01/batch_hour=06/b.parquet",
                  [{"job_id": "2", "title": "u", "salary_min": None, "tags": ["x"], "experience_min": 3},
                   {"job_id": "3", "title": None, "salary_min": 2.5, "tags": [], "experience_min": None}])
    _pandas_batch(f"{root}/batch_date=2024-01-02/batch_hour=00/c.parquet",
                  [{"job_id": "4", "company": "Acme", "category": "extra"}])
    kinds = {str(pq.read_schema(os.path.join(dp, f)).field("job_id").type)
             for dp, _, fs in os.walk(root) for f in fs}
    assert kinds == {"string"}
    df = scan_bronze(spark, root, posting_contract(), with_batch_columns=True)
    got = {r["job_id"]: r for r in df.collect()}
    assert set(got) == {"1", "2", "3", "4"}
    assert got["1"]["salary_min"] == 10.0 and got["3"]["salary_min"] == 2.5 and got["2"]["salary_min"] is None
    assert got["2"]["tags"] == ["x"] and got["1"]["tags"] == []
    assert got["3"]["title"] is None and got["4"]["company"] == "Acme" and got["4"]["source"] is None
    assert got["2"]["experience_min"] == 3 and got["4"]["crawled_at"] is None
    assert got["4"]["category"] == "extra" and got["1"]["category"] is None
    assert {got[k]["batch_hour"] for k in "124"} == {"05", "06", "00"} and got["1"]["batch_date"] == "2024-01-01"


def test_scan_bronze_folders(spark, tmp_dir):
    """A folder with files of two signatures, a folder below another one, and data columns named like path columns."""
    root = os.path.join(tmp_dir, "bronze")
    _pandas_batch(f"{root}/x/a.parquet", [{"job_id": "1", "run_id": "data", "n": 1}])
    _pandas_batch(f"{root}/x/b.parquet", [{"job_id": "2", "run_id": "data", "n": 1.5}])
    _pandas_batch(f"{root}/x/batch_hour=05/c.parquet", [{"job_id": "3", "run_id": "data", "n": 2}])
    _pandas_batch(f"{root}/y/d.parquet", [{"job_id": "4", "run_id": "data", "n": 3}])
    got = scan_bronze(spark, root)
    assert sorted((r["job_id"], r["run_id"], float(r["n"])) for r in got.collect()) == \
        [("1", "data", 1.0), ("2", "data", 1.5), ("3", "data", 2.0), ("4", "data", 3.0)]
    hours = scan_bronze(spark, root, with_batch_columns=True)
    assert {r["job_id"]: r["batch_hour"] for r in hours.collect()} == {"1": None, "2": None, "3": "05", "4": None}
    assert {r["run_id"] for r in hours.collect()} == {"data"}
    with pytest.raises(FileNotFoundError):
        os.makedirs(tmp_dir + "/none")
        scan_bronze(spark, tmp_dir + "/none")


def test_replay_in_another_hour(spark, tmp_dir):
    """A batch logged hours ago is written to the folder of its logged hour, also when it is replayed."""
    src, root, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "bronze", "ckpt"))
    os.makedirs(src)
    with open(f"{src}/m1.json", "w") as f:
        f.write('{"job_id": "1", "title": "a"}\n{"job_id": "2", "title": "b"}\n')

    def go():
        ingest_stream(read_stream(spark, "json", path=src), root, ckpt, available_now=True).awaitTermination()

    go()
    log = f"{ckpt}/offsets/0"
    lines = open(log).read().split("\n")
    meta = json.loads(lines[1])
    logged = meta["batchTimestampMs"] = meta["batchTimestampMs"] - 5 * 3_600_000
    hour = dt.datetime.fromtimestamp(logged / 1000, dt.timezone.utc).strftime("%H")
    os.remove(f"{ckpt}/offsets/.0.crc")
    open(log, "w").write("\n".join([lines[0], json.dumps(meta), *lines[2:]]))
    for name in os.listdir(root):
        if name.startswith("batch_date"):
            os.rename(f"{root}/{name}", f"{tmp_dir}/written-{name}")
    for _ in range(2):  # written, then replayed after a stop before the commit
        for name in os.listdir(f"{ckpt}/commits"):
            os.remove(f"{ckpt}/commits/{name}")
        go()
        rows = scan_bronze(spark, root, with_batch_columns=True).collect()
        assert sorted(r["job_id"] for r in rows) == ["1", "2"] and {r["batch_hour"] for r in rows} == {hour}


def test_two_streams_into_one_root_keep_all(spark, tmp_dir):
    root = os.path.join(tmp_dir, "bronze")
    for n in "12":
        src = os.path.join(tmp_dir, "src" + n)
        os.makedirs(src)
        with open(f"{src}/m.json", "w") as f:
            f.write('{"job_id": "%s", "title": "a"}\n' % n)
        ingest_stream(read_stream(spark, "json", path=src), root, f"{tmp_dir}/ckpt{n}", available_now=True).awaitTermination()
    assert sorted(r["job_id"] for r in scan_bronze(spark, root).collect()) == ["1", "2"]


def test_write_bronze_replay_is_idempotent(spark, tmp_dir):
    root = os.path.join(tmp_dir, "w")
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "job_id string, title string")
    ts = dt.datetime(2024, 5, 6, 7, 8, 9)
    write_bronze(df, root, "run1", ts)
    write_bronze(df, root, "run1", ts)
    write_bronze(df.limit(1), root, "run2", ts, partition_cols=["batch_date", "batch_hour", "batch_minute"])
    assert os.path.isdir(f"{root}/batch_date=2024-05-06/batch_hour=07/run_id=run1")
    assert scan_bronze(spark, root).count() == 3


def test_load_contract_from_avro_schema():
    c = load_contract({"type": "record", "name": "r", "fields": [
        {"name": "id", "type": "string"},
        {"name": "tags", "type": {"type": "array", "items": "string"}, "default": []},
        {"name": "n", "type": ["null", "int"], "default": None},
        {"name": "ok", "type": "boolean"},
        {"name": "ts", "type": "long"},
        {"name": "src", "type": "string", "default": "unknown"}]})
    assert c.fields == [("id", "string"), ("tags", "array<string>"), ("n", "int"), ("ok", "boolean"),
                        ("ts", "bigint"), ("src", "string")]
    assert c.defaults == {"id": None, "tags": [], "n": None, "ok": False, "ts": 0, "src": "unknown"}
    assert c.required_strings == {"id", "src"}
    assert len(posting_contract().fields) == 29


def test_apply_contract_defaults(spark):
    df = spark.createDataFrame([(None, "x", "12abc")], "job_id string, extra string, experience_min string")
    r = apply_contract(df).first()
    assert r["job_id"] == "" and r["title"] == "" and r["source"] == "unknown"
    assert r["tags"] == [] and r["is_urgent"] is False and r["experience_min"] is None and r["crawled_at"] == 0


def test_ingest_stream_restart_no_duplicates(spark, tmp_dir):
    src, root, bad, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "bronze", "bad", "ckpt"))
    os.makedirs(src)
    with open(f"{src}/m1.json", "w") as f:
        f.write('{"job_id": "1", "title": "a", "source": "topcv"}\n{not json\n')
    s = read_stream(spark, "json", {"maxFilesPerTrigger": "1"}, path=src)
    ingest_stream(s, root, ckpt, quarantine=bad, available_now=True).awaitTermination()
    with open(f"{src}/m2.json", "w") as f:
        f.write('{"job_id": "2", "title": "b", "source": "topdev", "salary": "10 - 20 triệu"}\n')
    s = read_stream(spark, "json", {"maxFilesPerTrigger": "1"}, path=src)
    ingest_stream(s, root, ckpt, quarantine=bad, available_now=True).awaitTermination()
    got = scan_bronze(spark, root, posting_contract())
    assert sorted(r["job_id"] for r in got.collect()) == ["1", "2"]
    assert [r["_raw"] for r in scan_bronze(spark, bad).collect()] == ["{not json"]


# An invented listing page and rules of its own, one for each selector form.
LISTING = """<!DOCTYPE html><html><body><nav><article>not an offer</article></nav><main id="offers">
<article class="offer top" data-ref='A&amp;1'>
  <header><h2>Lead <em>Pilot</em> &eacute;&#233;&#xE9;</h2><p>one</p><p lang=vi>hai</p></header>
  <section class="text"><article class="note">quoted <section>deep</section></article> after</section>
  <ul><li>first</li><li data-kind="pay base">10 - 20 triệu<li>third</ul>
  <a data-href="/bad" class="go now" href='/offers/lead-pilot-7/?from=list&amp;n=2'>see</a><br/><i>3 năm</i>
  <img src="/badges/new.svg" alt="New!"><div class="w-[10px] p-2">!</div>
</article>
<article class="offer"><section class="text"></section><footer><h2>Cook</h2></footer><a href="https://else.example/x">x</a></article>
</main></body></html>"""

OFFER = {
    "job_id": {"selector": None, "attribute": "data-ref"},
    "title": {"selector": "footer h2, header > h2", "attribute": "text"},
    "body": {"selector": "section.text", "attribute": "text"},
    "second": {"selector": "header p:nth-of-type(2)", "attribute": "text"},
    "language": {"selector": "p[lang]", "attribute": "lang"},
    "salary": {"selector": "[data-kind~='pay']", "attribute": "text"},
    "url": {"selector": "a.go[href^='/offers/']", "attribute": "href"},
    "experience": {"selector": "a + br + i", "attribute": "text"},
    "logo_url": {"selector": "img[src$='.svg'][alt*=\"ew\"]", "attribute": "src"},
    "is_flash": {"selector": "div.w-\\[10px\\].p-2", "attribute": "exists"},
    "is_urgent": {"selector": "#offers .top .urgent", "attribute": "exists"},
    "any": {"selector": "main *", "attribute": "text"},
}


def test_extract_every_selector_form(spark):
    pages = spark.createDataFrame([(1, LISTING), (2, None), (3, ""), (4, "<article class=offer>")], "page_id long, html string")
    with pytest.raises(ValueError):
        extract_items(pages, "div", {"page_id": {"selector": None}}, keep=("page_id",))
    for bad in ("a:hover", "p::before", "a[", "h2 ~ p"):
        with pytest.raises(ValueError):
            extract_items(pages, "article", {"x": {"selector": bad}}, keep=("page_id",))
    items = extract_items(pages, "main > article.offer, article.offer", OFFER, keep=("page_id",), base_url="https://site.example")
    got = {(r["page_id"], r["item_pos"]): r.asDict() for r in items.collect()}
    assert set(got) == {(1, 0), (1, 1), (4, 0)}
    a, b, c = got[1, 0], got[1, 1], got[4, 0]
    assert a["job_id"] == "A&1" and a["title"] == "LeadPilotééé"
    assert a["body"] == "quoteddeepafter" and a["second"] == "hai" and a["language"] == "vi"
    assert a["salary"] == "10 - 20 triệuthird" and a["experience"] == "3 năm"  # an open li holds what follows
    assert a["url"] == "https://site.example/offers/lead-pilot-7/?from=list&n=2"
    assert a["logo_url"] == "/badges/new.svg" and a["is_flash"] is True and a["is_urgent"] is False
    assert b["title"] == "Cook" and b["body"] is None and b["url"] is None and b["is_flash"] is False
    assert all(c[k] is None for k in OFFER if not k.startswith("is_"))


def test_listing_of_elements():
    from postlake.plans.pages import _Listing
    html = ("<!doctype html><!-- <b>no</b> --><DIV Class='a b' data-x=1 hidden title=\"1 > 0 &amp; 2\">t&lt;1 <br/>a < b<img src=x.png/>"
            "<script>if (a<b) '</div>'</script ><p>one<p>two</span></div> tail <b>open")
    page = _Listing()
    page.add("")
    page.add(html)
    got = page.column().to_pylist()
    assert got[0] == {"elements": [], "texts": []}
    elements = got[1]["elements"]
    assert [e["tag"] for e in elements] == ["div", "br", "img", "script", "p", "p", "b"]
    assert dict(elements[0]["attrs"]) == {"class": "a b", "data-x": "1", "hidden": "", "title": "1 > 0 & 2"}
    assert [e["up"] for e in elements] == [-1, 0, 0, 0, 0, 4, -1] and [e["path"] for e in elements][5:] == [[0, 4], []]
    assert [e["stop"] for e in elements] == [6, 2, 3, 4, 6, 6, 7] and [e["nth"] for e in elements] == [1, 1, 1, 1, 1, 1, 1]
    assert [e["left"] for e in elements] == [-1, -1, 1, 2, 3, -1, 0]
    assert got[1]["texts"] == ["t<1", "a < b", "one", "two", "tail", "open"]
    assert [(e["first"], e["last"]) for e in elements] == [(0, 4), (1, 1), (2, 2), (2, 2), (2, 4), (3, 4), (5, 6)]


def test_pages_without_end(spark):
    """Very long and deep pages, and markup that never closes, are listed in a pass."""
    import time

    from postlake.plans.pages import _Listing
    start = time.time()
    for html in ("<p>" * 3000, "<" * 200_000, '<a b="' * 30_000, "<!--" * 50_000, "<p a='x" + " y" * 200_000, "x" * 2_000_000, "</p>" * 100_000):
        _Listing().add(html)
    assert time.time() - start < 30


def test_first_in_document_order_and_later_parents(spark):
    html = '<div class=c><p class=b>B</p><p class=a>A</p><h3 class=t>x</h3><h3 class=t><a href="/y">Y</a></h3></div>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rules = {"either": {"selector": ".a, .b"}, "link": {"selector": "h3.t a", "attribute": "href"}, "self": {"selector": ".c .a"}}
    r = extract_items(pages, ".c", rules, keep=("page_id",)).first()
    assert (r["either"], r["link"], r["self"]) == ("B", "/y", "A")


def test_build_postings_from_items(spark):
    pages = spark.createDataFrame([(1, LISTING), (2, LISTING)], "page_id long, html string")
    items = extract_items(pages, "article.offer", {k: v for k, v in OFFER.items() if k not in ("body", "second", "language", "any")},
                          keep=("page_id",), base_url="https://site.example")
    rows = build_postings(items, "site", 1700000000).collect()
    lead = [r for r in rows if r["title"].startswith("Lead")]
    assert {r["job_id"] for r in lead} == {hashlib.sha256(b"https://site.example/offers/lead-pilot-7").hexdigest()}
    assert lead[0]["salary_min"] == 10_000_000.0 and lead[0]["experience_min"] == 3 and lead[0]["deal_salary"] is False
    cooks = [r for r in rows if r["title"] == "Cook"]
    assert len({r["job_id"] for r in cooks}) == 2 and all(len(r["job_id"]) == 64 and r["company"] == "" for r in cooks)


def test_items_of_different_companies_keep_apart(spark):
    df = spark.createDataFrame([("Dev", "A"), ("Dev", "B"), ("Dev", "B|"), ("Dev|B", "")], "title string, company string")
    ids = [r["job_id"] for r in build_postings(df, "s", 1).collect()]
    assert len(set(ids)) == 4 and sorted(ids) == sorted(r["job_id"] for r in build_postings(df, "s", 1).collect())


def test_crawl_audit_rules(spark):
    rows = []
    for page, ids in {1: range(0, 20), 2: range(20, 40), 3: range(40, 45), 4: range(45, 50),
                      5: range(50, 70)}.items():
        rows += [("s", page, str(i)) for i in ids]
    rows += [("t", 1, "a"), ("t", 2, "a"), ("t", 3, "b")]
    df = spark.createDataFrame(rows, "src string, page int, id string")
    out = {(r["source"], r["page"]): r for r in crawl_audit(df, "src", "page", "id").collect()}
    assert out[("s", 3)]["small_run"] == 1 and out[("s", 4)]["stop_reason"] == "small_pages"
    assert out[("s", 4)]["first_stop"] and out[("s", 5)]["small_run"] == 0
    assert out[("t", 2)]["stop_reason"] == "redundant" and out[("t", 2)]["identical_run"] == 1
    assert out[("t", 2)]["first_stop"] and not out[("t", 3)]["first_stop"]


def test_crawl_audit_compares_pages_of_equal_hashes(spark, monkeypatch):
    from postlake.plans import pages as P
    monkeypatch.setattr(P.F, "xxhash64", lambda *c: P.F.lit(7).cast("long"))
    rows = [("s", p, i) for p, ids in enumerate(["ab", "ab", "ba", "bb", "bb", "cb"]) for i in ids]
    out = {r["page"]: r["identical_run"] for r in crawl_audit(spark.createDataFrame(rows, "src string, page int, id string"), "src", "page", "id").collect()}
    assert out == {0: 0, 1: 1, 2: 2, 3: 0, 4: 1, 5: 0}


def test_crawl_audit_identical_pages(spark):
    rows = []
    for page in (1, 2, 3, 4):
        ids = ["a", "b", "b"] if page > 1 else ["a", "b"]
        rows += [("s", page, i) for i in ids]
    rows += [("u", 1, "x"), ("u", 2, "x"), ("u", 2, "y")]
    df = spark.createDataFrame(rows, "src string, page int, id string")
    out = {(r["source"], r["page"]): r for r in crawl_audit(df, "src", "page", "id").collect()}
    assert [out[("s", p)]["identical_run"] for p in (1, 2, 3, 4)] == [0, 0, 1, 2]
    assert out[("u", 2)]["identical_run"] == 0


CRAWLER = """
name: harbour
base_url: https://harbour.example
container_selector: "tr.row[data-open='yes']"
fields:
  title:
    selector: td.what > strong
    attribute: text
  url:
    selector: td.what a
    attribute: href
  is_urgent: {selector: "td:nth-of-type(3) b", attribute: exists}
"""


def test_crawler_config(spark, tmp_dir):
    path = os.path.join(tmp_dir, "harbour.yaml")
    with open(path, "w", encoding="utf-8") as f:
        f.write(CRAWLER)
    cfg = load_crawler_config(path)
    html = """<table><tr class="row" data-open="yes"><td class="what"><strong>Mate</strong><a href="/mate">more</a></td><td>x</td><td><b>now</b></td></tr>
    <tr class="row" data-open="no"><td class="what"><strong>Gone</strong></td></tr></table>"""
    got = extract_with_config(spark.createDataFrame([(1, html)], "page_id long, html string"), cfg).collect()
    assert [(r["title"], r["url"], r["is_urgent"]) for r in got] == [("Mate", "https://harbour.example/mate", True)]
    with open(path, "w", encoding="utf-8") as f:
        f.write("name: x\nfields: {}\n")
    with pytest.raises(ValueError):
        load_crawler_config(path)


def test_crawl_audit_empty_page(spark):
    items = spark.createDataFrame([("s", 1, "a"), ("s", 1, "b"), ("s", 3, "c")], "src string, page int, id string")
    crawled = spark.createDataFrame([("s", 1), ("s", 2), ("s", 3)], "src string, page int")
    out = {r["page"]: r for r in crawl_audit(items, "src", "page", "id", pages=crawled).collect()}
    assert out[2]["n_items"] == 0 and out[2]["stop_reason"] == "empty" and out[2]["redundancy"] == 1.0
    assert out[2]["first_stop"] and out[3]["stop_reason"] is None


def test_dedup_stream_and_new_counts(spark, tmp_dir):
    from postlake.streaming.dedup import dedup_stream, new_ids_per_minute
    src = os.path.join(tmp_dir, "ev")
    rows = [(1, "u1", dt.datetime(2024, 1, 1, 0, 0, 10)), (2, "u1", dt.datetime(2024, 1, 1, 0, 0, 40)),
            (3, "u2", dt.datetime(2024, 1, 1, 0, 1, 5)), (4, "u3", dt.datetime(2024, 1, 1, 0, 1, 30)),
            (5, "u9", dt.datetime(2024, 1, 1, 3, 0, 0))]
    spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz").coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = (dedup_stream(stream, "k", "ts", "10 minutes").select("k").writeStream.format("parquet")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == ["u1", "u2", "u3", "u9"]
    stream = spark.readStream.schema(schema).parquet(src)
    out2, ck2 = os.path.join(tmp_dir, "out2"), os.path.join(tmp_dir, "ck2")
    q = (new_ids_per_minute(stream, "k", "ts", "10 minutes").writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ck2).trigger(availableNow=True).start(out2))
    q.awaitTermination()
    got = {r["minute"]: r["new_ids"] for r in spark.read.parquet(out2).collect()}
    # windows close once the watermark passes them; the last one stays open
    assert got.get(dt.datetime(2024, 1, 1, 0, 0)) == 1 and got.get(dt.datetime(2024, 1, 1, 0, 1)) == 2


def test_read_stream_parquet_contract(spark, tmp_dir):
    src = os.path.join(tmp_dir, "p")
    apply_contract(spark.createDataFrame([("7", "t")], "job_id string, title string")).write.parquet(src)
    s = read_stream(spark, "parquet", path=src)
    out, ck = os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "c")
    s.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out) \
        .awaitTermination()
    r = spark.read.parquet(out).first()
    assert (r["job_id"], r["title"], r["_decoded"], r["source"]) == ("7", "t", True, "unknown")


@pytest.mark.parametrize("given", [{}, {"maxOffsetsPerTrigger": "9", "startingOffsets": "latest"}])
def test_kafka_stream_sets_no_limit_of_its_own(spark, given):
    class Reader:
        def format(self, name):
            assert name == "kafka"
            return self

        def options(self, **opts):
            self.opts = opts
            return self

        def load(self):
            return spark.createDataFrame([("{}",)], "value string")

    class Session:
        readStream = Reader()

    read_stream(Session, "kafka", {"subscribe": "t"} | given)
    assert Session.readStream.opts == {"subscribe": "t", "startingOffsets": "earliest"} | given
    read_stream(Session, "kafka", {"subscribe": "t"} | given, flush_rows=500)
    assert Session.readStream.opts == {"subscribe": "t", "startingOffsets": "earliest"} | given | {"minOffsetsPerTrigger": "500", "maxTriggerDelay": "30s"}
    with pytest.raises(ValueError):
        read_stream(spark, "json", path="x", flush_rows=500)


def test_decode_marks_malformed_json(spark):
    from postlake.sources.stream_io import CORRUPT, decode_value
    df = spark.createDataFrame([('{"job_id": "1", "title": "a"',), ('{"job_id": "2"}',)], "value string")
    got = df.select(decode_value(F.col("value"), posting_contract()).alias("d")).collect()
    assert got[0]["d"][CORRUPT] is not None and got[1]["d"][CORRUPT] is None and got[1]["d"]["job_id"] == "2"


def test_write_keyed_json(spark, tmp_dir):
    from postlake.sources.stream_io import write_keyed
    df = spark.createDataFrame([("1", "a"), ("", "b")], "job_id string, title string")
    path = os.path.join(tmp_dir, "keyed")
    write_keyed(df, "job_id", "json", path=path)
    got = {r["key"]: r["value"] for r in spark.read.json(path).collect()}
    assert got["1"] == '{"job_id":"1","title":"a"}'
    other = [k for k in got if k != "1"]
    assert len(other) == 1 and len(other[0]) == 64  # sha256 of the record for an empty id


def test_medallion_layers(spark, tmp_dir):
    from postlake.plans.medallion import run_medallion
    root = os.path.join(tmp_dir, "bronze")
    rows = [("1", "a", "topcv", 10), ("1", "a2", "topcv", 20), ("2", "b", "other", 5)]
    df = spark.createDataFrame(rows, "job_id string, title string, source string, crawled_at long")
    write_bronze(df, root, "r1")
    out = run_medallion(spark, root, select=("staging", "intermediate"))
    assert set(out) == {"stg_jobs", "int_jobs_dedup"}
    assert sorted((r["job_id"], r["title"]) for r in out["int_jobs_dedup"].collect()) == [("1", "a2"), ("2", "b")]
    out = run_medallion(spark, root, out_root=os.path.join(tmp_dir, "marts"))
    checks = {r["check_name"]: r["failures"] for r in out["checks"].collect()}
    assert len(checks) == 8 and checks["accepted_values_stg_jobs_source"] == 1
    assert checks["unique_dim_job_job_id"] == 0 and checks["not_null_dim_company_company_id"] == 0
    assert out["fact_job_posting"].count() == 3 and out["dim_company"].count() == 1
    with pytest.raises(ValueError):
        run_medallion(spark, root, select=("bronze",))


def test_dedup_stream_over_batches(spark, tmp_dir):
    """Without a delay no first sighting is lost, however late; with one, a record behind the watermark is."""
    from postlake.streaming.dedup import dedup_stream, mark_stream
    day = dt.datetime(2024, 1, 1)
    batches = [[(1, "a", 10), (2, "b", 10)], [(3, "a", 11), (4, "c", 2)], [(5, "d", 1), (6, None, 12), (7, None, 13), (8, "d", 1)]]
    src = os.path.join(tmp_dir, "src")
    schema = "id long, k string, ts timestamp_ntz"
    for n, batch in enumerate(batches):
        rows = [(i, k, day + dt.timedelta(hours=h)) for i, k, h in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        for name, delay in (("all", None), ("late", "1 hour")):
            (dedup_stream(stream, "k", "ts", delay).select("id", "k").writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ck-{name}")
             .trigger(availableNow=True).start(f"{tmp_dir}/{name}").awaitTermination())
        mark_stream(stream, "k", ["ts", "id"], f"{tmp_dir}/marked", f"{tmp_dir}/ck-mark", available_now=True).awaitTermination()
    assert sorted(str(r["k"]) for r in spark.read.parquet(f"{tmp_dir}/all").collect()) == ["None", "a", "b", "c", "d"]
    assert "d" not in {r["k"] for r in spark.read.parquet(f"{tmp_dir}/late").collect()}
    marked = {r["id"]: r["is_new"] for r in spark.read.parquet(f"{tmp_dir}/marked").collect()}
    assert marked == {1: True, 2: True, 3: False, 4: True, 5: True, 6: True, 7: False, 8: False}
    # a batch that is replayed before its commit gives the same rows
    commits = sorted(int(n) for n in os.listdir(f"{tmp_dir}/ck-mark/commits") if n.isdigit())
    for name in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        os.remove(f"{tmp_dir}/ck-mark/commits/{name}")
    stream = spark.readStream.schema(schema).parquet(src)
    mark_stream(stream, "k", ["ts", "id"], f"{tmp_dir}/marked", f"{tmp_dir}/ck-mark", available_now=True).awaitTermination()
    again = spark.read.parquet(f"{tmp_dir}/marked").collect()
    assert {r["id"]: r["is_new"] for r in again} == marked and len(again) == 8


def test_medallion_checks_can_fail(spark, tmp_dir):
    from postlake.plans.medallion import run_medallion
    rows = [("1", "a", "topcv", 10), (None, "b", None, None)]
    write_bronze(spark.createDataFrame(rows, "job_id string, title string, source string, crawled_at long"), tmp_dir + "/b", "r")
    out = run_medallion(spark, tmp_dir + "/b", out_root=tmp_dir + "/m")
    checks = {r["check_name"]: r["failures"] for r in out["checks"].collect()}
    assert [checks[f"not_null_stg_jobs_{c}"] for c in ("job_id", "source", "crawled_at")] == [1, 1, 1]
    assert checks["not_null_dim_job_job_id"] == 1 and out["fact_job_posting"].count() == 1


def test_marks_of_equal_records_and_two_checkpoints(spark, tmp_dir):
    """Of equal records one is new; a second checkpoint adds its rows and loses none; batches read their own keys' state."""
    from postlake.streaming.dedup import mark_stream
    from postlake.streaming.runs import read_counts
    schema = "k string, v int"
    batches = [[("a", 1), ("a", 1), ("b", 2), (None, 3)], [("a", 1), ("c", 1), ("c", 1), ("c", 0), (None, 3)]]
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/src")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/src")
        mark_stream(stream, "k", ["v"], f"{tmp_dir}/out", f"{tmp_dir}/ck1", True, f"{tmp_dir}/counts").awaitTermination()
    first = [(r["k"], r["v"], r["is_new"]) for r in spark.read.parquet(f"{tmp_dir}/out").collect()]
    want = [("a", 1, True), ("a", 1, False), ("a", 1, False), ("b", 2, True), (None, 3, True), (None, 3, False), ("c", 0, True), ("c", 1, False), ("c", 1, False)]
    assert sorted(first, key=str) == sorted(want, key=str)
    stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/src")
    mark_stream(stream, "k", ["v"], f"{tmp_dir}/out", f"{tmp_dir}/ck2", True, f"{tmp_dir}/counts").awaitTermination()
    rows = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert len(rows) == 18 and len({r["query"] for r in rows}) == 2 and sum(r["is_new"] for r in rows) == 8
    counts = {(r["query"], r["name"]): r["n"] for r in read_counts(spark, f"{tmp_dir}/counts").groupBy("query", "name").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    for q in {r["query"] for r in rows}:
        assert [counts[q, n] for n in ("records", "new", "repeated")] == [9, 4, 5]


def test_run_order_follows_what_relations_read():
    from postlake.plans.medallion import Relation, run_order
    assert run_order(["checks"]) == ["stg_jobs", "int_jobs_dedup", "dim_job", "dim_company", "checks"]
    assert run_order(["fact_job_posting"]) == ["stg_jobs", "fact_job_posting"]
    assert run_order(["marts", "staging"]) == ["stg_jobs", "int_jobs_dedup", "dim_company", "dim_job", "fact_job_posting"]
    own = {"a": Relation("x", ("b",), None), "b": Relation("x", ("a",), None), "c": Relation("y", ("d",), None)}
    with pytest.raises(ValueError, match="read each other"):
        run_order(["a"], own)
    with pytest.raises(ValueError, match="not declared"):
        run_order(["y"], own)


def test_merge_latest_reads_touched_buckets_only(spark, tmp_dir):
    import glob

    from postlake.operators.reshape import deduplicate, merge_latest, read_latest
    rows = [(f"k{i % 40}" if i % 13 else None, i * 7 % 101, f"v{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    order = [F.col("t").desc(), F.col("v")]
    root = tmp_dir + "/latest"
    assert merge_latest(spark, root, df.limit(0), "k", order, buckets=8) == 0
    assert merge_latest(spark, root, df.where("t < 60"), "k", order, buckets=8) == 8
    before = {p: os.path.getmtime(p) for p in glob.glob(root + "/*/*.parquet")}
    assert merge_latest(spark, root, df.where("t >= 60 and k in ('k1', 'k2')"), "k", order, buckets=8) in (1, 2)
    after = {p: os.path.getmtime(p) for p in glob.glob(root + "/*/*.parquet")}
    assert 0 < len(set(before.items()) - set(after.items())) <= 2  # the other buckets' files are the same
    for _ in range(2):  # a batch merged again changes nothing
        merge_latest(spark, root, df.where("t >= 60"), "k", order, buckets=8)
        want = deduplicate(df, ["k"], order).collect()
        assert sorted(map(str, read_latest(spark, root).collect())) == sorted(map(str, want)) and len(want) == 41


def test_listing_is_dealt_by_bytes_of_text(spark):
    """Long texts made from a small table are listed in tasks of bounded bytes, also behind a shuffle."""
    from postlake.session import TASK_BYTES, spread
    rows = 3 * spark.sparkContext.defaultParallelism
    texts = spark.range(rows).repartition(2).select("id", F.repeat(F.lit("x"), TASK_BYTES // 2).alias("t"))
    dealt = spread(texts, "t")
    assert dealt.rdd.getNumPartitions() == rows // 2 and dealt.count() == rows
    assert spread(texts.limit(0), "t").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_postings_are_built_in_tasks_of_bounded_text(spark):
    from postlake.session import TASK_BYTES
    cores = spark.sparkContext.defaultParallelism
    page = F.concat(F.lit("<div class=c><a href='/j/1'>A</a></div><!--"), F.repeat(F.lit("x"), TASK_BYTES), F.lit("-->"))
    pages = spark.range(2 * cores).coalesce(1).select(F.col("id").alias("page_id"), page.alias("html"))
    items = extract_items(pages, ".c", {"title": {"selector": "a"}, "url": {"selector": "a", "attribute": "href"}}, keep=("page_id",), base_url="https://a.example")
    built = build_postings(items, "s", F.col("page_id"))
    assert built.rdd.getNumPartitions() > 2 * cores and built.where("url = 'https://a.example/j/1' and title = 'A'").count() == 2 * cores


def test_listing_holds_slices_and_what_rules_read(spark, monkeypatch):
    """Pages are listed in slices of bounded text with the fields that the rules read; a batch has few rows and bytes."""
    from postlake.plans import pages as P
    from postlake.session import BATCH_BYTES, BATCH_ROWS
    read, names = P._reads("li", {"title": {"selector": "a"}, "url": {"selector": "ul > a.x[rel]", "attribute": "href"}})
    assert read == {"at", "stop", "first", "last", "tag", "css", "attrs", "up"} and names == {"rel", "href"}
    assert "path" in P._reads("ul li", {})[0] and "left" in P._reads("a + b", {})[0] and "nth" in P._reads("a:nth-of-type(2)", {})[0]
    html = [f"<ul><li class=k><a href=/{i} rel=r data-z=1>{i}</a>" for i in range(500)] + [None, ""]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id long, html string").coalesce(1)
    monkeypatch.setattr(P, "SLICE_CHARS", 200)
    listed = pages.select("page_id", P.list_elements(F.col("html"), ("at", "attrs"), ("href",)).alias("p")).collect()
    assert len(listed) == 502
    assert all(([e.asDict() for e in r.p.elements] == [{"at": 0, "attrs": {}}, {"at": 1, "attrs": {}}, {"at": 2, "attrs": {"href": f"/{r.page_id}"}}]
                and r.p.texts == [str(r.page_id)]) if r.page_id < 500 else r.p.elements == [] for r in listed)
    extract_items(pages, "li", {"title": {"selector": "a"}}, keep=("page_id",))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= BATCH_BYTES


def test_listing_parses_each_start_tag_once(monkeypatch):
    """Start tags of one text are parsed once for the pages listed together, however long they are and however often they come."""
    from postlake.plans import pages as P
    calls, parse = [], P._attributes
    monkeypatch.setattr(P, "_attributes", lambda rest, names: calls.append(rest) or parse(rest, names))
    tag = f" class='k' href=/a data-x='{'y' * 2 * P._KEPT_CHARS}'"
    listing = P._Listing(("at", "css", "attrs"), frozenset(["href"]))
    for _ in range(3):
        listing.add(f"<a{tag}>one</a>" * 20)
    got = listing.column().to_pylist()
    assert calls == [tag] and len(got) == 3
    assert all(page == {"elements": [{"at": i, "css": "k", "attrs": [("href", "/a")]} for i in range(20)], "texts": ["one"] * 20} for page in got)


def test_listing_of_scripts_and_siblings():
    """Text is hidden behind a script or style that does not close itself, up to its end tag; siblings are numbered within their own page."""
    from postlake.plans.pages import _Listing

    def listed(*pages):
        listing = _Listing()
        for html in pages:
            listing.add(html)
        return [([(e["tag"], e["up"], e["nth"], e["left"], e["stop"]) for e in page["elements"]], page["texts"]) for page in listing.column().to_pylist()]

    assert listed("<SCRIPT src='/a.js'><b>no</b></Script >yes", "<script src='/a.js'/><b>yes</b>", "<style>a<b", "<title='<script>'>x") == [
        ([("script", -1, 1, -1, 1)], ["yes"]), ([("script", -1, 1, -1, 1), ("b", -1, 1, 0, 2)], ["yes"]),
        ([("style", -1, 1, -1, 1)], []), ([("title='<script", -1, 1, -1, 1)], ["'>x"])]
    assert listed('<script"><b>">no</b></script>yes', "<p<script>yes</p>") == [([("script\"", -1, 1, -1, 2), ("b", 0, 1, -1, 2)], ['">no', "yes"]), ([("p<script", -1, 1, -1, 1)], ["yes"])]
    assert listed("<p>a<i>b</i><p>c", "", "<p></p><i></i><p></p>") == [
        ([("p", -1, 1, -1, 3), ("i", 0, 1, -1, 2), ("p", 0, 1, 1, 3)], ["a", "b", "c"]), ([], []),
        ([("p", -1, 1, -1, 1), ("i", -1, 1, 0, 2), ("p", -1, 2, 1, 3)], [])]


def test_methods_of_posting_steps_are_compiled(spark, capsys):
    """No generated method of the job is longer than the 8,000 bytes up to which a JVM compiles one."""
    fields = ("title", "company", "url", "salary", "experience", *(f"f{n}" for n in range(40)))
    pages = spark.range(2).select(F.col("id").alias("page_id"), F.format_string("<p class=c><a href='/j/%d'>A</a>", "id").alias("html"))
    cards = extract_items(pages, ".c", {n: {"selector": "a", "attribute": "href" if n == "url" else "text"} for n in fields}, keep=("page_id",))
    built = build_postings(cards, "s", F.col("page_id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no code before it runs
    try:
        built.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(part.split(";")[0]) for part in capsys.readouterr().out.split("maxMethodCodeSize:")[1:]]
    assert sizes and max(sizes) < 8000
    assert {r["job_id"] for r in built.collect()} == {hashlib.sha256(f"/j/{n}".encode()).hexdigest() for n in range(2)}


def test_selectors_look_up_elements_by_tag_or_class():
    """A page lists the places of the elements under the tags and classes that the rules' selectors end at."""
    from postlake.plans import pages as P
    rules = {"a": {"selector": "h3.title a, .title"}, "b": {"selector": "ul > li:nth-of-type(2)"}, "c": {"selector": "div [data-x]"}, "d": {"selector": "a.x.y[href]"}, "e": {"selector": "b[class~='p q']"}, "f": {}}
    keys = P._keys("DIV", rules)
    assert keys == [".title", ".x", "a", "b", "div", "li"]
    listing = P._Listing(("at",), None, keys)
    for html in ("<div class='x\ttitle x'><A class=Title></a><li><a class='y title'></div><b><script class=x>.title</script>", "", "<a>"):
        listing.add(html)
    assert [p["places"] for p in listing.column().to_pylist()] == [[[0, 3], [0, 5], [1, 3], [4], [0], [2]], [[]] * 6, [[], [], [0], [], [], []]]
    assert P._Listing(("at",), None, keys).column().to_pylist() == []


def test_class_words_of_selectors(spark):
    """A class is a whole word between white space, whatever characters it has; texts are null where they are empty."""
    html = "<p class='a\tb-c\n'><i class='x\\E'>1</i><i class='ab'>2</i><i class=' a '>3</i><i class='b-c.'>4</i><i class=\"q'\"> </i></p>"
    rules = {"a": {"selector": ".a"}, "bc": {"selector": "i.b-c\\."}, "e": {"selector": r"i.x\\E"}, "none": {"selector": "[class~='']"}, "two": {"selector": "[class~='a b']"},
             "empty": {"selector": "[class^=q]"}, "self": {"attribute": "class"}, "dup": {"selector": "i.a, .a, i"}}
    rows = extract_items(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string"), "p.a.b-c", rules, keep=("page_id",)).drop("page_id", "item_pos").collect()
    assert [r.asDict() for r in rows] == [{"a": "3", "bc": "4", "e": "1", "none": "3", "two": None, "empty": None, "self": "a\tb-c\n", "dup": "1"}]


def test_tags_are_paired_as_one_by_one():
    """Deep, crossed and stray tags end their elements like a stack would, in each page for itself."""
    from itertools import product

    from postlake.plans import pages as P

    def stack(tags):
        ups, stops, opened, here = [], [], [], 0
        for tag in tags:
            if tag[0] != "/":
                ups.append(opened[-1][0] if opened else -1)
                stops.append(here + 1)
                if tag != "br":
                    opened.append((here, tag))
                here += 1
            elif any(tag[1:] == t for _, t in opened):
                while True:
                    at, last = opened.pop()
                    stops[at] = here
                    if last == tag[1:]:
                        break
        for at, _ in opened:
            stops[at] = here
        return [{"up": u, "stop": s} for u, s in zip(ups, stops)]

    deep = ["a", "b"] * (2 * P._ROUNDS)
    pages = [*product(["a", "b", "br", "/a", "/b"], repeat=5), [*deep, *(f"/{t}" for t in reversed(deep))], [*deep, "/a"], ()]
    listing = P._Listing(("up", "stop"))
    for tags in pages:
        listing.add("".join(f"<{t}>" for t in tags))
    assert [p["elements"] for p in listing.column().to_pylist()] == [stack(tags) for tags in pages]
