"""Pictures cut out of page images, and models that read pages."""

import json

import numpy as np
import pytest
from examloom.operators import crops
from examloom.plans import paper
from examloom.sources import extractors, png
from pyspark.sql import functions as F


def page_image(height=200, width=100, channels=3):
    y, x = np.mgrid[0:height, 0:width]
    return np.stack([(x * (c + 1) + y) % 256 for c in range(channels)], axis=2).astype(np.uint8)


def filtered(pixels, kind):
    """A PNG whose rows all use one filter."""
    import struct
    import zlib

    h, w, c = pixels.shape
    rows, out = pixels.reshape(h, -1).astype(np.int32), []
    for y in range(h):
        up = rows[y - 1] if y else np.zeros(w * c, np.int32)
        left, corner = np.concatenate([np.zeros(c, np.int32), rows[y][:-c]]), np.concatenate([np.zeros(c, np.int32), up[:-c]])
        p = left + up - corner
        paeth = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
        guess = (0, left, up, (left + up) // 2, paeth)[kind]
        out.append(bytes([kind]) + ((rows[y] - guess) % 256).astype(np.uint8).tobytes())
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + b"\0\0\0\0"
    return png.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[c], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(out))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
def test_png(channels):
    pixels = np.random.default_rng(channels).integers(0, 256, (13, 7, channels)).astype(np.uint8)
    assert (png.read(png.write(pixels)) == pixels).all()
    for kind in range(5):
        assert (png.read(filtered(pixels, kind)) == pixels).all(), kind
    assert png.cut(pixels, -5, -5, 3, 4).shape == (4, 3, channels) and png.cut(pixels, 50, 50, 60, 60).shape == (1, 1, channels)
    assert png.stacked([pixels, pixels[:2, :3]], 1).shape == (16, 7, 3)
    for bad in (b"", b"x" * 40, png.SIGNATURE):
        with pytest.raises(ValueError):
            png.read(bad)


def test_crops(spark, tmp_path):
    image = png.write(page_image())
    images = spark.createDataFrame([("p", 1, image), ("p", 2, image), ("p", 3, b"broken")], "paper_id string, page int, image binary")
    box = [250.0, 250.0, 750.0, 750.0]
    regions = [("p", "one.png", 0, 1, box), ("p", "two.png", 1, 1, box), ("p", "two.png", 2, 2, [0.0, 0.0, 100.0, 1000.0]), ("p", "bad.png", 0, 3, box), ("q", "none.png", 0, 1, box)]
    found = crops.cut_out(spark.createDataFrame(regions, "paper_id string, name string, strip int, page int, bbox array<double>"), images, padding=0)
    got = {r["name"]: r for r in found.collect()}
    assert (got["one.png"]["width"], got["one.png"]["height"]) == (50, 100)
    assert (png.read(bytes(got["one.png"]["png"])) == page_image()[50:150, 25:75]).all()
    assert (got["two.png"]["width"], got["two.png"]["height"]) == (100, 100 + 20 + crops.GAP)
    assert got["bad.png"]["png"] is None and "no PNG image" in got["bad.png"]["error"] and "no picture" in got["none.png"]["error"]
    files = {r["name"]: r["path"] for r in crops.write_files(found, str(tmp_path)).collect()}
    assert sorted(files) == ["one.png", "two.png"] and open(files["one.png"], "rb").read() == bytes(got["one.png"]["png"])
    names = spark.createDataFrame([("4",), ("12",), ("P-a b",)], "r string").select(crops.asset_name(F.col("r"), F.lit("stem"), F.lit(2)).alias("n"), crops.asset_name(F.col("r"), F.lit("options"), F.lit(None)).alias("o"))
    assert [tuple(r) for r in names.collect()] == [("q04-stem-2.png", "q04-options.png"), ("q12-stem-2.png", "q12-options.png"), ("qp-a-b-stem-2.png", "qp-a-b-options.png")]
    strips = spark.createDataFrame([("p", 7, 1, 36.0, 84.2, 559.3, 421.0)], "paper_id string, question int, page int, x0 double, y0 double, x1 double, y1 double")
    sizes = spark.createDataFrame([("p", 1, 595.3, 842.0)], "paper_id string, page int, width double, height double")
    row = crops.question_strips(strips, sizes).first()
    assert row["name"] == "q07.png" and [round(v) for v in row["bbox"]] == [100, 60, 500, 940]


def block(kind, **more):
    return {"type": kind} | more


PAGES = {
    1: {"questions": [
        {"question_ref": "Q01", "content": [block("text", value="stem"), block("image")], "options": {"mode": "text", "items": [{"label": x, "content": x} for x in "ABCD"]}, "stem_visuals": [{"bbox": [0, 0, 500, 500]}], "requires_review": False},
        {"question_ref": "2", "content": [block("text", value="begins"), block("image")], "options": {"mode": "composite_visual", "labels": list("ABCD")}, "options_bbox": [1, 2, 3, 4], "requires_review": False},
    ]},
    2: {"questions": [{"question_ref": "q2", "content": [block("text", value="goes on")], "options": None, "requires_review": True}, {"question_ref": "3", "content": [], "options": {"mode": "composite_visual", "labels": list("ABCD")}}]},
    4: {"unexpected": 1},
}


def test_questions_that_a_model_reads(spark):
    said = {n: json.dumps(p) for n, p in PAGES.items()}

    def model(page):
        if page["page"] == 3:
            raise OSError("no answer")
        return said[page["page"]]

    pages = spark.createDataFrame([("p", n, f"page {n}", None) for n in (1, 2, 3, 4)], "paper_id string, page int, context string, image binary")
    found = extractors.materialized(extractors.questions(pages, model, attempts=2))
    rows = {(r["page"], r["question_ref"]): r for r in found.collect()}
    assert sorted(rows) == [(1, "1"), (1, "2"), (2, "2"), (2, "3"), (3, "page-3-failed"), (4, "page-4-failed")]
    first, second = rows[1, "1"], rows[1, "2"]
    assert [(b["type"], b["asset"]) for b in first["content"]] == [("text", None), ("image", "q01-stem-1.png")]
    assert [(p["name"], p["role"]) for p in first["pictures"]] == [("q01-stem-1.png", "stem")]
    assert [b["type"] for b in second["content"]] == ["text"] and second["options"]["asset"] == "q02-options.png" and [p["role"] for p in second["pictures"]] == ["options"]
    assert rows[2, "3"]["requires_review"] and not second["requires_review"]
    failed = rows[3, "page-3-failed"]
    assert failed["requires_review"] and failed["content"][0]["value"] == "[parse failed on page 3: OSError: no answer]" and failed["options"]["labels"] == list("ABCD")
    assert "declared form" in rows[4, "page-4-failed"]["content"][0]["value"]
    merged = {r["question_ref"]: r for r in extractors.merged(found).collect()}
    assert [b["value"] for b in merged["2"]["content"]] == ["begins", "goes on"] and merged["2"]["requires_review"] and merged["2"]["page"] == 1 and len(merged["2"]["source_regions"]) == 2
    facts = {r["question_ref"]: r for r in paper.option_facts(extractors.merged(found), spark.createDataFrame([("q02-options.png",)], "name string")).collect()}
    assert facts["2"]["asset_exists"] and facts["1"]["labels"] == list("ABCD") and facts["1"]["image_assets"] == ["q01-stem-1.png"]


def test_answers_that_a_model_reads(spark):
    said = {1: [("Q1", "a", None), ("02", "B", None)], 2: [("1", "C", "why"), ("2", "D", None)]}

    def key(page):
        if page["page"] == 9:
            raise ValueError("no")
        return json.dumps({"answers": [dict(zip(("question_ref", "answer", "explanation"), a)) for a in said[page["page"]]]})

    pages = spark.createDataFrame([("k", n, "", None) for n in (1, 2, 9)], "paper_id string, page int, context string, image binary")
    assert sorted(tuple(r) for r in extractors.answers(pages, key).collect()) == [("k", "1", "C", "why"), ("k", "2", "B", None)]
