"""CSV files, listings, image folders, views, the shared folder."""

import struct
import zlib

import pytest

from millrace.session import scratch_path, shared_dir
from millrace.sources import class_names, list_files, preview_lines, read_csv, read_image_folder, register, sql


def png(r, g, b):
    """A 2 x 2 picture of one colour."""

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    header = struct.pack(">IIBBBBB", 2, 2, 8, 2, 0, 0, 0)
    lines = b"".join(b"\x00" + bytes([r, g, b]) * 2 for _ in range(2))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


@pytest.fixture
def pictures(tmp_path):
    for name, colour, n in (("wood", (255, 0, 0), 3), ("air", (0, 255, 0), 2), ("stone", (0, 0, 255), 1)):
        (tmp_path / name).mkdir()
        for i in range(n):
            (tmp_path / name / f"{i}.png").write_bytes(png(*colour))
    return str(tmp_path)


def test_image_folder(spark, pictures):
    assert class_names(spark, pictures) == ["air", "stone", "wood"]
    rows = read_image_folder(spark, pictures).collect()
    assert sorted((r["class_name"], r["label"]) for r in rows) == (
        [("air", 0)] * 2 + [("stone", 1)] + [("wood", 2)] * 3
    )
    wood = next(r for r in rows if r["class_name"] == "wood")["image"]
    assert (wood["height"], wood["width"], wood["nChannels"]) == (2, 2, 3)
    assert bytes(wood["data"][:3]) == b"\x00\x00\xff"  # blue, green, red
    raw = read_image_folder(spark, pictures, decode=False).first()["image"]
    assert bytes(raw).startswith(b"\x89PNG")
    with pytest.raises(Exception, match="not a class"):
        read_image_folder(spark, pictures, names=["air", "wood"]).collect()


def test_image_listing_reads_no_content(spark, pictures):
    files = list_files(spark, pictures, "*.png")
    assert files.count() == 6
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def test_csv_schema_keeps_blanks(spark, tmp_path):
    path = tmp_path / "census.csv"
    path.write_text("39, State-gov, <=50K\n50, ?, >50K\n")
    schema = "age double, workclass string, income string"
    kept = read_csv(spark, str(path), schema=schema)
    assert [r["workclass"] for r in kept.collect()] == [" State-gov", " ?"]
    assert [r["income"] for r in read_csv(spark, str(path), schema=schema, trim=True).collect()] == ["<=50K", ">50K"]


def test_csv_header_and_cast(spark, tmp_path):
    path = tmp_path / "white.csv"
    path.write_text('"fixed acidity";"quality"\n7.4;5\nbad;8\n')
    text = read_csv(spark, str(path), header=True, sep=";")
    assert dict(text.dtypes) == {"fixed acidity": "string", "quality": "string"}
    typed = read_csv(spark, str(path), header=True, sep=";", cast_to="double")
    assert [tuple(r) for r in typed.collect()] == [(7.4, 5.0), (None, 8.0)]
    assert [r["value"] for r in preview_lines(spark, str(path), 1).collect()] == ['"fixed acidity";"quality"']


def test_views(spark):
    df = spark.range(3)
    register(df, "three")
    assert sql(spark, "SELECT count(*) FROM three").first()[0] == 3
    assert sql(spark, "SELECT sum(id) FROM {t}", t=df).first()[0] == 3


def test_scratch_below_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert spark.sparkContext.getCheckpointDir() is not None
