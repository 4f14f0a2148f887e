"""Results must not depend on how files are cut, on newer letters, or on what workers have installed."""

import hashlib
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ridemart.llm import decontaminate, exact_dedup, jaccard_join, warc
from ridemart.session import new_folder

SIZE = "spark.sql.files.maxPartitionBytes"


@pytest.mark.parametrize("prefix", ["", warc.VERSION, "junk "])
def test_records_survive_another_layout(spark, monkeypatch, prefix):
    """Between the look at the boundaries and the payloads, the files are cut anew, as after a lost executor."""
    trap = f"{warc.VERSION}WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(k, f"http://x/{k}", f"<p>{k % 7}</p>" * (k % 40) + (trap * 2 if k % 11 == 0 else "")) for k in range(300)]
    pages += [(7, "http://x/7", pages[7][2]), (7, "http://x/7", pages[7][2]), (900, "u", warc.VERSION + "q")]
    path = new_folder(spark, "layout")
    warc.write_pages(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2), path)
    if prefix:
        spark.createDataFrame([(prefix,)], "value string").coalesce(1).write.mode("append").option("lineSep", " ").text(path)
    jump, before = warc.reachable, spark.conf.get(SIZE)

    def meanwhile(links):
        found = jump(links)
        spark.conf.set(SIZE, "3000")
        return found

    monkeypatch.setattr(warc, "reachable", meanwhile)
    try:
        spark.conf.set(SIZE, "20000")
        records = warc.read_records(spark, path).collect()
    finally:
        spark.conf.set(SIZE, before)
    # A bare version line at the start of a file is a record without a length.
    assert sum(not row.intact for row in records) == (prefix == warc.VERSION)
    records = [row for row in records if row.intact]
    assert len(records) == len(pages)
    assert sorted(row.payload for row in records if row.type == "response") == sorted(
        html for k, (page, _, html) in enumerate(pages)
        if len(html.encode()) < warc.REVISIT_BYTES or page == max(other for other, _, same in pages if same == html)
    )


def test_only_ascii_capitals_are_folded(spark):
    letters = [chr(c) for c in (0x2C2F, 0xA7C0, 0xA7D0, 0xA7CB, 0x10570, 0x10D50, 0x1E9E, 0x130, 0x1F88, 0x24B6, 0x2160, 0x3A3, 0xC9)]
    rows = [(k, f"Ab {letter}") for k, letter in enumerate(letters)] + [(100 + k, f"aB {letter.lower()}") for k, letter in enumerate(letters)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {row.doc_id: row for row in exact_dedup.mark_copies(docs).collect()}
    for name, text in rows:
        folded = "".join(c.lower() if c.isascii() else c for c in text)
        assert got[name].text_sha256 == hashlib.sha256(folded.encode()).hexdigest(), text
        assert got[name].group_size == sum("".join(c.lower() if c.isascii() else c for c in other) == folded for _, other in rows)


def test_clashing_columns(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, text, "a", "b"), (2, text, "c", "d"), (None, text, "e", "f")], "doc_id long, text string, _dropped string, _leak string")
    assert {row._dropped for row in jaccard_join.keep_one(docs).collect()} == {"a", "e"}
    benchmark = spark.createDataFrame([(1, text)], "item_id long, text string")
    left = decontaminate.drop_leaks(docs, benchmark)
    assert left.columns == docs.columns and [row._leak for row in left.collect()] == ["f"]


WORKERS = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from ridemart.session import local_session
spark = local_session(4)
for name in sys.argv[2:]:
    entry.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save(); print(name, flush=True)
"""


def test_workers_need_not_have_the_package(tmp_path):
    """Every query that starts Python workers, from an empty folder and without the repository on PYTHONPATH."""
    import os

    root = Path(__file__).resolve().parents[2]
    names = [
        "op1_ngram_jaccard_join", "op2_license_scans", "op3_benchmark_decontamination", "op4_byte_bpe", "op5_secret_scans",
        "op7_quality_classifier", "op9_toxicity", "op11_line_dedup", "op13_fill_in_middle",
    ]
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", WORKERS, str(root), *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    found = [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")]
    assert found == names, done.stderr[-2000:]
