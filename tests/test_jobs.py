"""The jobs over growing input, run again, and from the command line."""

import logging
import os
import subprocess
import sys
from collections import Counter

import pytest


from jobs import intake, term_audit
from jobs.common import config_of

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


UNIT = ("lang", "doc_id", "line", "id", "source_hash", "chars", "tokens", "protected", "problems", "text")
TEXT = ("lang", "source_hash", "text", "chars", "tokens", "problems")


def test_intake_takes_only_what_is_new(spark, sf_dir, tmp_path, caplog):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en"), (9002, "", "en"), (9003, "a\r\n\r\n b \rćé\n{x} %s <t>\n***\n�", None), (9004, "x" * 2001, ""), (9004, "x" * 2001, "")], intake.DOCUMENT)
    deliveries = [docs.filter("doc_id % 3 = 0"), docs.filter("doc_id % 3 = 1"), docs.filter("doc_id % 3 = 2").select("doc_id", "text", "lang").unionByName(odd)]
    inbox, out, mark = (str(tmp_path / x) for x in ("inbox", "out", "mark"))
    config = config_of("intake", files_per_batch=2)
    caplog.set_level(logging.INFO, "jobs")
    totals = Counter()
    for delivery in deliveries:
        delivery.repartition(3).write.mode("append").parquet(inbox)
        got = intake.run(spark, inbox, out, mark, config)
        assert got["documents"] == delivery.count()
        totals.update(got)
        before = rows_of(intake.read(spark, out, "units"), *UNIT, "batch"), rows_of(intake.read(spark, out, "texts"), *TEXT, "batch")
        assert set(intake.run(spark, inbox, out, mark, config).values()) == {0}
        assert before == (rows_of(intake.read(spark, out, "units"), *UNIT, "batch"), rows_of(intake.read(spark, out, "texts"), *TEXT, "batch"))
    assert "read" in caplog.text and f"wrote {got['units']} units" in caplog.text
    units, texts = intake.read(spark, out, "units"), intake.read(spark, out, "texts")
    assert units.select("batch").distinct().count() > 3
    whole = intake.units_of(spark.read.parquet(inbox), config)
    assert rows_of(units, *UNIT) == rows_of(whole, *UNIT) and units.count() == totals["units"]
    assert rows_of(texts, *TEXT) == rows_of(whole.select(*TEXT).distinct(), *TEXT) and texts.count() == totals["texts"]
    found = {r["id"]: r for r in units.filter("doc_id > 9000").collect()}
    assert {k: (r["lang"], r["text"], r["protected"], r["problems"]) for k, r in found.items() if r["doc_id"] == 9003} == {
        "9003:1": ("und", "a", 0, ""), "9003:3": ("und", " b ", 0, ""), "9003:4": ("und", "ćé", 0, "unicode-normalization"), "9003:5": ("und", "{x} %s <t>", 3, ""), "9003:6": ("und", "***", 0, "no-words"), "9003:7": ("und", "�", 0, "invalid-character,no-words"),
    }
    assert found["9004:1"]["problems"] == "too-long" and units.filter("doc_id = 9004").count() == 2 and texts.filter("chars = 2001").count() == 1
    assert not units.filter("doc_id in (9001, 9002)").count()


def test_a_batch_run_again_leaves_the_same(spark, sf_dir, tmp_path):
    """As after a failure between a batch's writes and its commit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out, config, totals = str(tmp_path / "out"), config_of("intake"), Counter()
    take = intake.take(out, config, totals)
    take(docs.filter("doc_id % 2 = 0"), 0)
    take(docs.filter("doc_id % 2 = 1"), 1)
    first = [rows_of(intake.read(spark, out, name), "lang", "source_hash", "batch") for name in ("units", "texts")]
    take(docs.filter("doc_id % 2 = 1"), 1)
    assert first == [rows_of(intake.read(spark, out, name), "lang", "source_hash", "batch") for name in ("units", "texts")]


def test_intake_of_one_file_and_of_an_empty_folder(spark, tmp_path):
    spark.createDataFrame([(1, "a\nb", "en")], intake.DOCUMENT).coalesce(1).write.parquet(str(tmp_path / "d"))
    file = next((tmp_path / "d").glob("part-*"))
    assert intake.run(spark, str(file), str(tmp_path / "o"), str(tmp_path / "c"), config_of("intake"))["units"] == 2
    (tmp_path / "none").mkdir()
    assert intake.run(spark, str(tmp_path / "none"), str(tmp_path / "o2"), str(tmp_path / "c2"), config_of("intake"))["units"] == 0


def audited(spark, out):
    return rows_of(spark.read.schema(term_audit.HIT).parquet(f"{out}/hits"), "lang", "doc_id", "term", "source", "target", "status"), rows_of(spark.read.parquet(f"{out}/terms"), "term", "source", "documents")


def test_audit_runs_again_and_by_language(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO, "jobs")
    docs = [(1, "Kenji walks to the Temple", "en", "s1"), (2, "le temple de kenji", "fr", "s1"), (3, None, "en", "s1"), (4, "a temple", "en", "s2"), (5, "temple", None, "s1")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "docs"))
    (tmp_path / "g.tsv").write_text('source\ttarget\tstatus\tscope\tsource_locale\tcase_sensitive\nKenji\tKenji\tlocked\t\t\tyes\ntemple\ttemple\tpreferred\t\t\t\ntemple\ttemple\tpreferred\tfr\t\t\n"two\twords"\tx\t\t\t\t\nKenji\tX\tlocked\t\tja\t\nwalk\tmarche\tlocked\ts2\t\t\n', encoding="utf-8")
    paths = (str(tmp_path / "docs"), str(tmp_path / "g.tsv"), str(tmp_path / "out"))
    got = term_audit.run(spark, *paths, config_of("term_audit"))
    assert got == {"documents": 5, "terms": 4, "hits": 5, "unused": 2} and "read 5 documents" in caplog.text and "wrote 5 hits" in caplog.text
    hits, terms = audited(spark, paths[2])
    assert hits == Counter([("en", 1, 0, "Kenji", "Kenji", "locked"), ("en", 1, 1, "temple", "temple", "preferred"), ("fr", 2, 1, "temple", "temple", "preferred"), ("en", 4, 1, "temple", "temple", "preferred"), ("und", 5, 1, "temple", "temple", "preferred")])
    assert {t[1]: t[2] for t in terms} == {"Kenji": 1, "temple": 4, "two\twords": 0, "walk": 0}
    term_audit.run(spark, *paths, config_of("term_audit"))
    assert (hits, terms) == audited(spark, paths[2])
    spark.createDataFrame([(7, "Kenji, kenji", "fr", "s1"), (8, "temple", "en", "s1")], "doc_id long, text string, lang string, source string").write.mode("append").parquet(paths[0])
    for _ in range(2):
        assert term_audit.run(spark, *paths, config_of("term_audit", langs=["fr"]))["documents"] == 2
        now, terms = audited(spark, paths[2])
        assert now == hits + Counter([("fr", 7, 0, "Kenji", "Kenji", "locked")]) and {t[1]: t[2] for t in terms}["Kenji"] == 2


def test_settings(tmp_path):
    assert config_of("intake", most_chars=5)["most_chars"] == 5
    with pytest.raises(ValueError, match="no such setting: chars"):
        config_of("intake", chars=5)
    (tmp_path / "c.json").write_text('{"langs": ["de"]}')
    assert config_of("term_audit", str(tmp_path / "c.json"))["langs"] == ["de"]


def test_the_command_line(sf_dir, tmp_path):
    (tmp_path / "c.json").write_text('{"most_chars": 100}')
    args = ["--documents", f"{sf_dir}/documents.parquet", "--out", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "mark"), "--config", str(tmp_path / "c.json")]
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 pyspark-shell"}
    done = subprocess.run([sys.executable, "-m", "jobs.intake", *args], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read 200 new documents" in done.stderr and list((tmp_path / "out" / "texts").glob("lang=*"))
    assert subprocess.run([sys.executable, "-m", "jobs.term_audit"], cwd=ROOT, capture_output=True, timeout=60).returncode == 2
