import pytest
from pyspark.sql import functions as F

from rainfold.session import scratch_path
from rainfold.sources import csvfiles, jsondocs, zipcsv


def test_zip_csv_roundtrip_with_empty_fields(spark):
    df = spark.createDataFrame([(1, 2.5, None), (2, None, 3.0), (3, 1.0, 1.0)], "t int, a double, b double")
    path = scratch_path(spark, "t-zip")
    zipcsv.write_zip_csv(df.repartition(2), path)
    back = zipcsv.read_zip_csv(spark, path, "t int, a double, b double")
    assert sorted(back.collect(), key=lambda r: r["t"]) == sorted(df.collect(), key=lambda r: r["t"])


def test_csv_write_fails_if_exists(spark):
    path = scratch_path(spark, "t-csv")
    df = spark.range(3)
    csvfiles.write_csv(df, path)
    with pytest.raises(Exception):
        csvfiles.write_csv(df, path)
    assert sorted(r["id"] for r in csvfiles.read_csv(spark, path).collect()) == [0, 1, 2]


def test_replace_load_has_no_duplicates(spark):
    path = scratch_path(spark, "t-table")
    df = spark.range(10)
    csvfiles.replace_table(df, path)
    csvfiles.replace_table(df, path)
    assert csvfiles.read_table(spark, path).count() == 10


def test_json_payload_flatten(spark):
    entries = spark.createDataFrame(
        [("d1", 0, "x", 1.0, 2.0), ("d1", 1, "y", None, 3.0), ("d2", 0, "z", 4.0, 5.0)],
        "doc string, pos long, dt_txt string, temp double, humidity double")
    path = scratch_path(spark, "t-json")
    jsondocs.write_payloads(entries, path, "doc", "pos")
    flat = jsondocs.flatten_payload(jsondocs.read_payloads(spark, path))
    got = sorted((r["doc"], r["pos"], r["temp"], r["humidity"]) for r in flat.collect())
    assert got == [("d1", 0, 1.0, 2.0), ("d1", 1, None, 3.0), ("d2", 0, 4.0, 5.0)]


def test_zip_with_several_members_and_header_per_member(spark):
    import io
    import os
    import zipfile

    from rainfold.session import local_path

    path = local_path(scratch_path(spark, "t-zip-multi"))
    os.makedirs(path)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("a.csv", "t,v\n1,1.5\n2,\n")
        zf.writestr("b.csv", "t,v\n3,3.5\n")
        zf.writestr("dir/", "")
    with open(os.path.join(path, "x.zip"), "wb") as fh:
        fh.write(buf.getvalue())
    got = sorted(tuple(r) for r in zipcsv.read_zip_csv(spark, path, "t int, v double").collect())
    assert got == [(1, 1.5), (2, None), (3, 3.5)]


def _archive(spark, text):
    import os
    import zipfile

    from rainfold.session import local_path

    path = local_path(scratch_path(spark, "t-zip-bad"))
    os.makedirs(path)
    with zipfile.ZipFile(os.path.join(path, "x.zip"), "w") as zf:
        zf.writestr("a.csv", text)
    return path


def test_blank_lines_are_skipped_and_malformed_ones_named(spark):
    path = _archive(spark, "t,v\n1,1.5\n\n  \n2,x,y,z\n3,2.5\n")
    read = lambda how: zipcsv.read_zip_csv(spark, path, "t int, v double", malformed=how)
    assert sorted(tuple(r) for r in read("drop").collect()) == [(1, 1.5), (3, 2.5)]
    assert read("null").count() == 3
    with pytest.raises(Exception, match="malformed line"):
        read("raise").collect()


def test_load_from_headed_csv_goes_by_names(spark):
    landing, path = scratch_path(spark, "t-landing"), scratch_path(spark, "t-loaded")
    csvfiles.write_csv(spark.createDataFrame([(1, "x", 2.5), (2, None, None)], "b int, a string, c double"), landing)
    for _ in range(2):
        csvfiles.load_table(spark, landing, path, "c double, b long")
    got = csvfiles.read_table(spark, path)
    assert dict(got.dtypes) == {"b": "bigint", "a": "string", "c": "double"}
    assert sorted(tuple(r) for r in got.collect()) == [(1, "x", 2.5), (2, None, None)]


def _zip(path, members, **how):
    import zipfile

    with zipfile.ZipFile(path, "w") as zf:
        for name, text, method in members:
            info = zipfile.ZipInfo(name)
            info.compress_type = method
            with zf.open(info, "w", **how) as fh:
                fh.write(text)


def test_members_are_read_as_streams_and_no_cell_holds_any(tmp_path, monkeypatch):
    import tracemalloc
    import zipfile

    import pandas as pd
    import pyarrow as pa

    monkeypatch.setattr(zipcsv, "BATCH_LINES", 2048)
    line, n, path = "1,1.5," + "x" * 190, 100_000, str(tmp_path / "x.zip")
    for method in (zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA, zipfile.ZIP_STORED):
        rows = n if method == zipfile.ZIP_DEFLATED else 1000
        _zip(path, [("d/a.csv", (line + "\r\n").encode() * rows, method), ("b.csv", "é\n".encode(), method)], force_zip64=True)
        dealt = pd.concat(zipcsv._members(zipcsv.open_seekable, 1 << 30)(iter([pd.DataFrame({"path": [path]})])))
        assert list(dealt["member"]) == ["d/a.csv", "b.csv"] and list(dealt.columns) == ["path", "at", "member", "start", "end"]
        tracemalloc.start()
        got = []
        for b in zipcsv._lines(zipcsv.open_seekable)(iter([pa.RecordBatch.from_pandas(dealt, preserve_index=False)])):
            got.append((b["member"][0].as_py(), b.num_rows, set(b["value"].to_pylist())))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(k for m, k, _ in got if m == "d/a.csv") == rows and all(v == {line} for m, _, v in got if m == "d/a.csv")
        assert [v for m, _, v in got if m == "b.csv"] == [{"é"}]
        if method == zipfile.ZIP_DEFLATED:  # the others' dictionaries are of fixed, larger sizes
            assert peak < n * len(line) / 4, peak


@pytest.mark.parametrize("part", [1, 17, 64, 1000])
def test_stored_members_are_read_in_parts(spark, tmp_path, part):
    import random
    import zipfile

    rng = random.Random(part)
    rows = [(i, "y" * rng.choice([0, 1, 5, 90])) for i in range(12 if part == 1 else 120)]
    text = "t,v\n" + "".join(f"{i},{v}" + rng.choice(["\n", "\r\n", "\n\n"]) for i, v in rows)
    _zip(tmp_path / "a.zip", [("a.csv", text[:-1].rstrip().encode(), zipfile.ZIP_STORED), ("b.csv", b"t,v\n-1,z", zipfile.ZIP_DEFLATED), ("c.csv", b"", zipfile.ZIP_STORED)])
    with pytest.warns(UserWarning, match="Duplicate name"):
        _zip(tmp_path / "b.zip", [("a.csv", b"t,v\n-2,q\n", zipfile.ZIP_STORED), ("a.csv", b"t,v\n-3,\n", zipfile.ZIP_STORED)])
    got = zipcsv.read_zip_csv(spark, str(tmp_path), "t int, v string", part_bytes=part).collect()
    want = [(i, v or None) for i, v in rows] + [(-1, "z"), (-2, "q"), (-3, None)]
    assert sorted((r["t"], r["v"]) for r in got) == sorted(want)


def test_a_damaged_member_raises(spark, tmp_path):
    import zipfile

    _zip(tmp_path / "a.zip", [("a.csv", b"t,v\n1,2.5\n", zipfile.ZIP_STORED)])
    raw = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "a.zip").write_bytes(raw.replace(b"1,2.5", b"1,9.5"))
    with pytest.raises(Exception, match="CRC"):
        zipcsv.read_zip_csv(spark, str(tmp_path), "t int, v double").collect()


def test_archives_beyond_the_binary_sources_limit(spark, tmp_path):
    """No archive is a cell: the source's own limit for one doesn't bind."""
    import zipfile

    _zip(tmp_path / "a.zip", [("a.csv", b"t,v\n" + b"1,2.5\n" * 1000, zipfile.ZIP_STORED)])
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        assert zipcsv.read_zip_csv(spark, str(tmp_path), "t int, v double").count() == 1000
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_an_opener_stands_in_for_other_stores(spark, tmp_path):
    import zipfile

    _zip(tmp_path / "a.zip", [("a.csv", b"t,v\n1,2.5\n", zipfile.ZIP_DEFLATED)])
    root = str(tmp_path)
    opener = lambda path: open(f"{root}/{path.rsplit('/', 1)[-1]}", "rb")  # noqa: E731, SIM115
    assert [tuple(r) for r in zipcsv.read_zip_csv(spark, root, "t int, v double", opener=opener).collect()] == [(1, 2.5)]
