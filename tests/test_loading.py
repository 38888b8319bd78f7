"""The one-scan load and the batch ledger: odd files, observed totals, crashes and repetitions."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows_of
from twinledger.sources import loading
from twinledger.streaming.ledger import BatchLoad

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("note", T.StringType()), T.StructField("amt", T.DoubleType())])
YEARLY = T.StructType([*SCHEMA.fields, T.StructField("YEAR", T.IntegerType())])


def put(folder, **files):
    for name, text in files.items():
        path = folder / (name.replace("__", "/") + ".csv")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(folder)


def test_odd_values_and_totals_in_one_scan(spark, tmp_path):
    source = put(tmp_path / "in", a='id,note,amt\n1,"x, ""y""",1.5\n2,,nan\n3,"",\n\n', b="﻿id,note,amt\r\n4, b ,2.25\r\n")
    load = loading.load_csv(spark, source, SCHEMA, str(tmp_path / "out"), totals=["amt"], null_tokens=("nan",))
    assert rows_of(load.table) == [("1", 'x, "y"', 1.5), ("2", None, None), ("3", "", None), ("4", " b ", 2.25)]
    assert (load.n_rows, load.n_files, load.totals, load.rejected) == (4, 2, {"amt": 3.75}, {"amt": 0})
    assert rows_of(loading.loaded_totals({"c": (load, "amt")})) == [("c", 3.75, 3.75, 0.0, 0, True)]


def test_rejected_values_are_counted_and_told(spark, tmp_path):
    source = put(tmp_path / "in", a="id,note,amt\n1,n,$5\n2,n,2\n")
    with pytest.raises(Exception, match="amt: not double"):
        loading.load_csv(spark, source, SCHEMA, str(tmp_path / "out"), totals=["amt"])
    load = loading.load_csv(spark, source, SCHEMA, str(tmp_path / "out"), totals=["amt"], on_bad="null")
    assert rows_of(loading.loaded_totals({"c": (load, "amt")})) == [("c", 2.0, 2.0, 0.0, 1, False)]


@pytest.mark.parametrize("text, problem", [
    ('id,note,amt\n1,"a\nb",1\n', "line break"), ("id,note,amt\n1,n\n", "Malformed|MALFORMED"), ("id,note,amt\n1,n,1,2\n", "Malformed|MALFORMED"),
    ("other,note,amt\n1,n,1\n", "header|not double"), ("id,note\n1,n\n", r"\['amt'\] are not in the input"), ("", "no header"), ("id,ID,amt\n1,2,3\n", "twice"),
])
def test_what_is_no_table_fails(spark, tmp_path, text, problem):
    source = put(tmp_path / "in", a=text if "other" not in text else "id,note,amt\n9,n,9\n", **({"b": text} if "other" in text else {}))
    with pytest.raises(Exception, match=problem):
        loading.load_csv(spark, source, SCHEMA, str(tmp_path / "out"), on_bad="null" if "other" in text else "fail")


def test_years_come_from_paths(spark, tmp_path):
    source = put(tmp_path / "in", y2008__a="id,note,amt\n1,n,1\n", y2009__b="id,note,amt\n2,n,2\n")
    paths = sorted(glob.glob(f"{source}/*"))
    by_pattern = loading.load_csv(spark, paths, YEARLY, str(tmp_path / "out"), {"YEAR": loading.from_path(r"/y(\d+)/")})
    named = loading.load_csv(spark, paths, YEARLY, str(tmp_path / "out2"), {"YEAR": loading.by_path(spark, {2008: paths[0], 2009: [paths[1]]})})
    assert rows_of(by_pattern.table) == rows_of(named.table) == [("1", "n", 1.0, 2008), ("2", "n", 2.0, 2009)]
    with pytest.raises(Exception, match="is not in the path"):
        loading.load_csv(spark, paths, YEARLY, str(tmp_path / "out3"), {"YEAR": loading.from_path(r"/z(\d+)/")})


def load_of(spark, tmp_path, **options):
    return BatchLoad(spark, str(tmp_path / "in"), SCHEMA.names, SCHEMA, str(tmp_path / "loaded"), totals=["amt"], **options)


def test_ledger_survives_a_crash_between_rows_and_entry(spark, tmp_path):
    put(tmp_path / "in", a="id,note,amt\n1,n,1.5\n")

    def die(number):
        raise RuntimeError("killed")
    with pytest.raises(Exception, match="killed"):
        load_of(spark, tmp_path, before_entry=die).run()
    batches = load_of(spark, tmp_path)
    assert batches.entries().count() == 0 and batches.table().count() == 0
    batches.run()
    put(tmp_path / "in", b="id,note,amt\n2,n,2\n3,n,\n")
    batches.run()
    batches.run()
    assert rows_of(batches.table()) == [("1", "n", 1.5), ("2", "n", 2.0), ("3", "n", None)]
    assert [tuple(r) for r in rows_of(batches.entries().select("n_rows", "n_files", "n_rejected", "column", "file_total"))] == [(1, 1, 0, "amt", 1.5), (2, 1, 0, "amt", 2.0)]


def test_ledger_skips_a_batch_whose_note_was_lost(spark, tmp_path):
    put(tmp_path / "in", a="id,note,amt\n1,n,1.5\n")
    batches = load_of(spark, tmp_path)
    batches.run()
    for note in glob.glob(str(tmp_path / "loaded" / "checkpoint" / "commits" / "*")) + glob.glob(str(tmp_path / "loaded" / "checkpoint" / "commits" / ".*crc")):
        os.remove(note)
    written = glob.glob(str(tmp_path / "loaded" / "table" / "*" / "part*"))
    batches.run()
    assert glob.glob(str(tmp_path / "loaded" / "table" / "*" / "part*")) == written and batches.table().count() == 1


def test_ledger_refuses_torn_quotes_and_counts_rejects(spark, tmp_path):
    one = T.StructType([T.StructField("note", T.StringType())])
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.csv").write_text('note\n"ab\ncd"\n')
    torn = BatchLoad(spark, str(tmp_path / "one"), ["note"], one, str(tmp_path / "one-loaded"))
    with pytest.raises(Exception, match="line breaks"):
        torn.run()
    assert torn.table().count() == 0
    put(tmp_path / "in", a="id,note,amt\n1,n,$1\n2,n,2\n")
    batches = load_of(spark, tmp_path, on_bad="null")
    batches.run()
    assert rows_of(batches.entries().select("n_rows", "n_rejected", "file_total")) == [(2, 1, 2.0)]
    assert batches.table().where(F.col("amt").isNull()).count() == 1


def test_ledger_parses_a_batch_once_and_takes_no_file_without_rows(spark, tmp_path):
    """The stream itself passes on lines, so that only the job that writes a batch parses it."""
    (tmp_path / "in").mkdir()
    header = ",".join(SCHEMA.names)
    (tmp_path / "in" / "a.csv").write_text(header + "\n")
    batches = load_of(spark, tmp_path)
    batches.run()
    assert batches.entries().count() == 0
    seen = []
    write = batches._write
    batches._write = lambda batch, number: (seen.append(batch.columns), write(batch, number))
    (tmp_path / "in" / "b.csv").write_text(header + "\n" + ",".join("1" for _ in SCHEMA.names) + "\n")
    batches.run()
    assert seen == [["value", "__file"]]
    assert [(e["n_rows"], e["n_files"]) for e in batches.entries().collect()] == [(1, 1)]
