"""PDF files written here, read back."""

import zlib

import pytest
from examloom.plans import paper
from examloom.sources import pages, pdf
from pyspark.sql import functions as F


def written(contents, packed=False, streams=False):
    """A PDF file of pages with two fonts and a picture; ``packed``: Flate; ``streams``: dictionaries in an object stream."""
    unicode_ = b"1 beginbfchar <0001> <0041> endbfchar 2 beginbfrange <0002> <0004> <0062> <0005> <0006> [<2082> <00480032>] endbfrange"
    objects = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>",
        2: b"<< /Type /Pages /MediaBox [0 0 600 800] /Resources 3 0 R /Count %d /Kids [%s] >>" % (len(contents), b" ".join(b"%d 0 R" % (20 + 2 * i) for i in range(len(contents)))),
        3: b"<< /Font << /F1 4 0 R /F2 5 0 R >> /XObject << /I 7 0 R /Fm 9 0 R >> >>",
        4: b"<< /Type /Font /Subtype /TrueType /FirstChar 32 /Widths [" + b"500 " * 90 + b"] >>",
        5: b"<< /Type /Font /Subtype /Type0 /ToUnicode 6 0 R /DescendantFonts [8 0 R] >>",
        8: b"<< /Type /Font /DW 1000 /W [1 [600 700] 3 6 500] >>",
    }
    bodies = {6: (b"", unicode_), 7: (b"/Subtype /Image /Width 1 /Height 1", b"\0"), 9: (b"/Subtype /Form /Matrix [1 0 0 1 10 0]", b"BT /F1 10 Tf 1 0 0 1 50 100 Tm (in a form) Tj ET")}
    for i, c in enumerate(contents):
        objects[20 + 2 * i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (21 + 2 * i)
        bodies[21 + 2 * i] = b"", c
    if streams:
        listed = list(objects.items())
        head, body = b"", b""
        for n, o in listed:
            head += b"%d %d " % (n, len(body))
            body += o + b" "
        bodies[50] = b"/Type /ObjStm /N %d /First %d" % (len(listed), len(head)), head + body
        objects = {}
    out = b"%PDF-1.5\n"
    for n, o in objects.items():
        out += b"%d 0 obj\n%s\nendobj\n" % (n, o)
    for n, (head, body) in bodies.items():
        if packed and n != 7:
            body, head = zlib.compress(body), head + b" /Filter /FlateDecode"
        out += b"%d 0 obj\n<< %s /Length %d >>\nstream\n%s\nendstream\nendobj\n" % (n, head, len(body), body)
    return out + b"trailer << /Root 1 0 R >>\n%%EOF"


TEXT = rb"""BT /F1 10 Tf 77 700 Td (1 Which \(metal\) is it\077) Tj 0 -20 Td (A) Tj 1 0 0 1 101 660 Tm [(ir) 20 (on) -2000 (far)] TJ 12 TL T* (next) Tj ET
q 200 0 0 100 50 300 cm /I Do Q BT /F2 10 Tf 1 0 0 1 77 200 Tm <000100020003000500060009> Tj ET /Fm Do"""


@pytest.mark.parametrize("packed,streams", [(False, False), (True, False), (True, True)])
def test_pdf(packed, streams):
    first, second = pdf.pdf_reader(written([TEXT, b"BT /F1 10 Tf 50 50 Td (two) ' ET"], packed, streams))
    assert (first["width"], first["height"], second["page"]) == (600.0, 800.0, 2)
    got = [(line["text"], round(line["x0"]), round(line["y0"])) for line in first["lines"]]
    assert got == [("1 Which (metal) is it?", 77, 90), ("A", 77, 110), ("iron", 101, 130), ("far", 141, 130), ("next", 101, 142), ("Abc₂H2�", 77, 590), ("in a form", 60, 690)]
    assert [tuple(first["images"][0][k] for k in ("x0", "y0", "x1", "y1"))] == [(50.0, 400.0, 250.0, 500.0)]
    assert second["raw_text"] == "two" and pdf.is_sparse("two") and not pdf.is_sparse("x" * 60) and pdf.is_sparse("�" * 30 + "x" * 40)


def test_pdf_errors_and_ocr(spark, tmp_path):
    for bad in (b"", b"plain text", b"%PDF trailer << /Encrypt 5 0 R >>"):
        with pytest.raises(ValueError):
            list(pdf.pdf_reader(bad))
    assert list(pdf.pdf_reader(b"%PDF nothing else")) == []
    assert [p["used_ocr"] for p in pdf.with_ocr(pdf.pdf_reader, lambda _, n: f"1 Seen on {n}\n\n x")(written([TEXT, b""]))] == [False, True]
    assert [p["used_ocr"] for p in pdf.with_ocr(pdf.pdf_reader, lambda _, n: "", False)(written([b""]))] == [False]
    question = b"BT /F1 10 Tf 77 700 Td (1 Which metal is extracted by electrolysis?) Tj " + b" ".join(b"1 0 0 1 101 %d Tm (%s metal %d) Tj" % (660 - 20 * i, b"ABCD"[i : i + 1], i) for i in range(4)) + b" ET"
    (tmp_path / "p.pdf").write_bytes(written([question], True, True))
    (tmp_path / "bad.pdf").write_bytes(b"x")
    found = pages.read_files(spark, str(tmp_path), pdf.pdf_reader, "*.pdf")
    assert found.where("error is not null").first()["paper_id"] == "bad.pdf"
    read = found.where(F.col("error").isNull())
    row = paper.parse_mcq(paper.Layout(pages.lines(read), pages.images(read), pages.tables(read), pages.page_sizes(read)), 1).first()
    assert row["stem"] == "Which metal is extracted by electrolysis?" and [row["options"][x]["text"] for x in "ABCD"] == [f"metal {i}" for i in range(4)]


def test_cells_of_a_table():
    cell = lambda r, c, t, **more: {"row": r, "column": c, "text": t} | more
    headed = [cell(0, 0, "gas", header=True), cell(0, 1, " molar  mass ", header=True, column_span=2), cell(1, 0, "x", row_span=2), cell(1, 1, "1"), cell(1, 2, "2"), cell(2, 1, "3"), cell(2, 2, None)]
    assert pdf.cell_matrix(headed) == (["gas", "molar mass", "molar mass"], [["x", "1", "2"], ["x", "3", ""]])
    assert pdf.cell_matrix([cell(0, 1, "a"), cell(1, 0, "b")]) == ([], [["", "a"], ["b", ""]]) and pdf.cell_matrix([]) == ([], [])
