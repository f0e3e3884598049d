"""CSV landing (S1-S4) on hand-made files with the usual CSV traps."""

import os

import pytest

from marquee.sources import landing as S
from marquee.sources.synthetic import RAW_COLUMNS

HEADER = ",".join(RAW_COLUMNS)


def write(scratch, name, text):
    d = os.path.join(scratch.replace("file:", ""), name)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part.csv"), "w", encoding="utf-8") as f:
        f.write(text)
    return d


def test_csv_traps(spark, scratch):
    text = (HEADER + "\n"
            's1,Movie,"Hello, World",,"A ""B"" C","X, ","March 5, 2019",2019,PG,93 min,Dramas,"two\nlines"\n'
            "s2,TV Show,Short\n"
            's3,Movie,T3,,,,,2000,,90 min,,""\n')
    path = write(scratch, "traps", text)
    df = S.read_csv_landing(spark, path)
    rows = {r["show_id"]: r for r in df.collect()}
    assert len(rows) == 3
    r1 = rows["s1"]
    assert r1["title"] == "Hello, World"
    assert r1["director"] is None            # empty field -> NULL
    assert r1["cast"] == 'A "B" C'           # doubled quote
    assert r1["country"] == "X, "            # outer space kept: nothing trimmed
    assert r1["description"] == "two\nlines"  # quoted newline
    r2 = rows["s2"]
    assert r2["title"] == "Short" and r2["description"] is None  # short row padded
    assert all(f.dataType.typeName() == "string" for f in df.schema.fields)


def test_contract_missing_and_extra(spark, scratch):
    path = write(scratch, "missing", "show_id,type\ns1,Movie\n")
    with pytest.raises(S.ContractError):
        S.read_csv_landing(spark, path)
    extra = write(scratch, "extra", HEADER + ",bonus\n" + "s1" + "," * 12 + "x\n")
    df = S.read_csv_landing(spark, extra, surplus=False)
    assert df.columns[-1] == "bonus" and df.first()["bonus"] == "x"
    assert S.check_contract(df.columns)["extra"] == ["bonus"]


def test_roundtrip_profile_and_size(spark, scratch):
    from marquee.sources.synthetic import synthetic_landing
    from tests.conftest import SF_SMALL
    raw = synthetic_landing(spark, SF_SMALL)
    path = S.write_csv_landing(raw, scratch + "/rt")
    back = S.read_csv_landing(spark, path, surplus=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, raw.collect()))
    prof = {r["column_name"]: r["null_rows"] for r in S.landing_profile(back).collect()}
    assert prof["director"] == 500 and prof["cast"] == 163 and prof["country"] == 141
    size = S.landing_size(back).first()
    assert (size["rows"], size["columns"]) == (1500, 12)


def test_compressed_landing_is_read_back(spark, scratch):
    df = spark.createDataFrame([(f"s{i}", *[f' "{c}",\n' for c in RAW_COLUMNS[1:]]) for i in range(500)],
                               S.all_string_schema())
    path = S.write_csv_landing(df, scratch + "/gz", compression="gzip")
    assert S.read_header(spark, path) == list(RAW_COLUMNS)
    assert sorted(map(tuple, S.read_csv_landing(spark, path, surplus=False).collect())) == sorted(map(tuple, df.collect()))


def test_contract_forms_come_from_one_landing(spark, monkeypatch):
    """The four forms are written from a kept landing, whole, and compressed."""
    from marquee import registry
    from tests.conftest import SF_SMALL
    seen, write_csv = [], S.write_csv_landing

    def spied(df, path, **kw):
        seen.append((df, kw, write_csv(df, path, **kw)))
        return seen[-1][2]

    monkeypatch.setattr(S, "write_csv_landing", spied)
    registry.QUERIES["s2_landing_contract"](spark, SF_SMALL)
    assert len(seen) == 4 and all(kw == {"compression": "gzip"} for _, kw, _ in seen)
    for df, _, path in seen:
        assert all("/raw/" in f for f in df.inputFiles())
        assert spark.read.csv(path, header=True, multiLine=True).count() == 1500


def test_splittable_and_rebalanced_reads(spark, scratch):
    from marquee.sources.synthetic import synthetic_landing
    from tests.conftest import SF_SMALL
    raw = synthetic_landing(spark, SF_SMALL)
    path = S.write_csv_landing(raw.coalesce(1), scratch + "/one_file")
    want = sorted(map(tuple, raw.collect()))
    flat = S.read_csv_landing(spark, path, multi_line=False, surplus=False)
    assert sorted(map(tuple, flat.collect())) == want
    even = S.read_csv_landing(spark, path, partitions=6, surplus=False)
    assert even.rdd.getNumPartitions() == 6
    assert sorted(map(tuple, even.collect())) == want


def test_empty_fields_land_as_null_quoted_or_not(spark, scratch):
    path = write(scratch, "empties", HEADER + "\n" + 's1,"",,  ," ",x,,,,,,\n')
    r = S.read_csv_landing(spark, path).first()
    assert r["type"] is None and r["title"] is None          # "" and empty -> NULL
    assert r["director"] == "  " and r["cast"] == " "        # whitespace kept as landed


def test_long_rows_keep_every_value(spark, scratch):
    long = ",".join(f"v{i}" for i in range(14))
    path = write(scratch, "long", HEADER + "\n" + long + "\n" + "s2,TV Show,Short\n" + 's3,"a, b"' + "," * 10 + ',"x, y"\n')
    rows = {r["show_id"]: r for r in S.read_csv_landing(spark, path).collect()}
    assert rows["v0"]["description"] == "v11" and rows["v0"][S.SURPLUS] == long
    assert rows["s2"][S.SURPLUS] is None and rows["s2"]["title"] == "Short"
    assert rows["s3"]["type"] == "a, b" and rows["s3"][S.SURPLUS].endswith('"x, y"')


def test_files_in_another_column_order_fail(spark, scratch):
    path = write(scratch, "mixed", HEADER + "\ns1,Movie,Title" + "," * 9 + "\n")
    other = [*RAW_COLUMNS]
    other[1], other[2] = other[2], other[1]
    with open(os.path.join(path, "second.csv"), "w", encoding="utf-8") as f:
        f.write(",".join(other) + "\ns2,Title,Movie" + "," * 9 + "\n")
    with pytest.raises(Exception, match="header"):
        S.read_csv_landing(spark, path).collect()


def test_results_come_back_as_written_and_in_order(spark, scratch):
    from pyspark.sql import functions as F

    from marquee.sources.sinks import read_result_csv, write_result_csv
    df = spark.createDataFrame([(i, f"\tv{i} ") for i in range(100)], "n int, v string")
    sorted_parts = df.repartitionByRange(4, F.desc("n")).sortWithinPartitions(F.desc("n"))
    path = write_result_csv(sorted_parts, scratch + "/parts")
    back = read_result_csv(spark, path, df.schema, [F.desc("n")]).collect()
    assert [tuple(r) for r in back] == [(i, f"\tv{i} ") for i in range(99, -1, -1)]


def test_shared_folder_is_required_off_the_local_machine():
    from types import SimpleNamespace

    from marquee.session import workspace_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace_dir(SimpleNamespace(sparkContext=context, conf=conf))
