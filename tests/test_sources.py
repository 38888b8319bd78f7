from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import types as T

from helpers import pair_of, rows_of
from twinledger.operators import fields, rows
from twinledger.session import scratch_dir
from twinledger.sources import controls, lookups, schemas, tables
from twinledger.streaming.incremental import load_new_csv_files

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("YEAR", T.IntegerType()), T.StructField("amt", T.DoubleType())])


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_is_read_by_name_cleaned_and_typed(spark, tmp_path):
    a = write(tmp_path / "a.csv", "amt,id\n1.5,x\nnan,NaN\n,y\noops,z\n")
    df = tables.read_csv_table(spark, a, SCHEMA, {"YEAR": 2008}, on_bad="null")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SCHEMA]
    assert rows_of(df) == [(None, 2008, None), ("x", 2008, 1.5), ("y", 2008, None), ("z", 2008, None)]
    raw = tables.with_constants(tables.read_text_csv(spark, a), {"YEAR": 2008})
    assert rows_of(tables.cast_failures(raw, SCHEMA)) == [("amt", 1)]


def test_yearly_files_are_united(spark, tmp_path):
    paths = {year: write(tmp_path / f"{year}.csv", f"id,amt\nm{year},1\n") for year in (2008, 2009, 2010)}
    assert rows_of(tables.read_yearly_csv_table(spark, paths, SCHEMA)) == [(f"m{y}", y, 1.0) for y in paths]


def test_missing_columns_and_other_headers_fail(spark, tmp_path):
    a = write(tmp_path / "d" / "a.csv", "id,amt\nx,1\n")
    b = write(tmp_path / "d" / "b.csv", "amt,id\n1,x\n")
    with pytest.raises(ValueError, match="YEAR"):
        tables.read_csv_table(spark, a, SCHEMA)
    with pytest.raises(Exception, match="header"):
        tables.read_text_csv(spark, [a, b]).collect()


def test_control_totals(spark, tmp_path):
    raw = tables.read_text_csv(spark, write(tmp_path / "a.csv", "id,amt\nx,1.25\ny,nan\nz,2\n"))
    table = spark.createDataFrame([("x", 1.25), ("z", 2.0)], "id string, amt double")
    totals = controls.control_totals([controls.ControlTotal("ok", raw, table, "amt"), controls.ControlTotal("lost", raw, table.where("id = 'x'"), "amt")])
    assert rows_of(totals) == [("lost", 3.25, 1.25, 2.0, 0, False), ("ok", 3.25, 3.25, 0.0, 0, True)]
    with pytest.raises(ValueError, match="lost"):
        controls.require_match(totals)


def test_values_that_do_not_fit_fail_the_load_and_the_control(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,amt\nx,$7\ny,10.5\n")
    with pytest.raises(Exception, match="amt: not double"):
        tables.read_csv_table(spark, path, SCHEMA, {"YEAR": 2008}).collect()
    raw = tables.read_text_csv(spark, path)
    table = tables.read_csv_table(spark, path, SCHEMA, {"YEAR": 2008}, on_bad="null")
    assert rows_of(controls.control_totals([controls.ControlTotal("x", raw, table, "amt")])) == [("x", 10.5, 10.5, 0.0, 1, False)]


def test_quotes_and_line_breaks_and_empty_texts_survive(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("amt", T.DoubleType())])
    data = [('Smith "Al", Jr', 5.0), ("two\nlines", 6.0), ("", 7.0), ("  ", None), (None, 8.0)]
    tables.write_csv(spark.createDataFrame(data, schema), str(tmp_path / "out"))
    back = tables.read_csv_table(spark, str(tmp_path / "out"), schema, null_tokens=(), multi_line=True)
    assert rows_of(back) == sorted(data, key=lambda row: tuple((v is not None, str(v)) for v in row))
    with pytest.raises(ValueError, match="line breaks"):
        tables.read_text_csv(spark, str(tmp_path / "out"))


@pytest.mark.parametrize("row", ["x", "x,1,2"])
def test_ragged_rows_fail_or_are_reported(spark, tmp_path, row):
    path = write(tmp_path / "a.csv", f"id,amt\n{row}\ny,2\n")
    with pytest.raises(Exception):
        tables.read_text_csv(spark, path).collect()
    found = tables.read_text_csv(spark, path, on_malformed="report")
    assert [r[tables.CORRUPT] for r in found.collect()] == [row, None]


def test_lookups(spark, tmp_path):
    assert lookups.state_lookup(spark).count() == 52 and lookups.sex_lookup(spark).count() == 2 and lookups.race_lookup(spark).count() == 6
    formulas = [{"Variable names": "PAID", "Labels": "Paid", "Sum of": "A + B", "Type": "NUM"}]
    path = write(tmp_path / "f.json", "﻿" + json.dumps(formulas))
    assert rows_of(lookups.read_payment_formulas(spark, path)) == [("PAID", "Paid", "A + B", "NUM")]
    path = write(tmp_path / "l.csv", "﻿File Source, #, Variable Names, Labels\nClaims, 5-12, C_1 – C_8, Code 1, or so\n")
    assert rows_of(lookups.read_variable_labels(spark, path)) == [("Claims", "5-12", "C_1 – C_8", "Code 1, or so")]


def test_schemas():
    assert len(schemas.MEMBER_SCHEMA) == 33 and len(schemas.MEMBER_SPEC.fields) == 31
    assert len(schemas.CLAIM_SCHEMA) == 142 and len(schemas.CLAIM_SPEC.fields) == 138 and len(schemas.CLAIM_SPEC.amounts) == 65


def test_incremental_load_takes_new_files_once(spark, tmp_path):
    columns = ["id", "amt"]
    table, checkpoint = scratch_dir(spark, "t"), scratch_dir(spark, "c")

    def load():
        load_new_csv_files(spark, str(tmp_path / "in"), columns, SCHEMA, table, checkpoint, {"YEAR": 2008}, files_per_batch=1).awaitTermination()
        return rows_of(spark.read.schema(SCHEMA).parquet(table))

    write(tmp_path / "in" / "a.csv", "id,amt\nx,1\n")
    write(tmp_path / "in" / "b.csv", "id,amt\ny,nan\n")
    assert load() == [("x", 2008, 1.0), ("y", 2008, None)]
    write(tmp_path / "in" / "c.csv", "id,amt\nz,3\n")
    assert load() == [("x", 2008, 1.0), ("y", 2008, None), ("z", 2008, 3.0)]
    assert len(load()) == 3


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + os.sep)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark):
    """Tables bucketed by claim id serve joins on the claim id and on longer keys."""
    data = [(str(i), 1, "x", float(i), 1.0) for i in range(200)]
    pair = pair_of(spark, data, data[:150], nullable_keys=False)
    from twinledger.model import TablePair
    stored = TablePair(pair.spec, tables.write_bucketed(pair.src, "src_toy", ["id"], 4), tables.write_bucketed(pair.new, "new_toy", ["id"], 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flags = fields.field_flags(stored)
        assert "Exchange" not in plan_of(flags)
        assert flags.count() == 200 and fields.field_flags(stored, only_defects=True).count() == 50
        assert "Exchange" not in plan_of(rows.missing_rows(stored)) and rows.missing_rows(stored).count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
