import zlib

from chunkwright.functions import pdf
from chunkwright.sources import readers


def obj(n, body):
    return f"{n} 0 obj\n".encode() + (body if isinstance(body, bytes) else body.encode()) + b"\nendobj\n"


def stream(data, packed=True, more=""):
    raw = zlib.compress(data) if packed else data
    return f"<< /Length {len(raw)} {'/Filter /FlateDecode ' if packed else ''}{more}>>\nstream\n".encode() + raw + b"\nendstream"


def document(*pages, packed=True):
    """Each page's content stream; pages in two levels, the last one first in the file."""
    kids = " ".join(f"{10 + 2 * i} 0 R" for i in range(len(pages)))
    cmap = b"1 beginbfchar <0041> <03A9> endbfchar 1 beginbfrange <0042> <0044> <0061> endbfrange"
    out = [obj(1, "<< /Type /Catalog /Pages 2 0 R >>"), obj(2, "<< /Type /Pages /Kids [3 0 R] /Count 1 /Resources 6 0 R >>"), obj(3, f"<< /Type /Pages /Parent 2 0 R /Kids [{kids}] >>"), obj(6, "<< /Font << /F1 7 0 R /F2 8 0 R >> >>"), obj(7, "<< /Type /Font >>"), obj(8, "<< /Type /Font /ToUnicode 9 0 R >>"), obj(9, stream(cmap))]
    for i, p in reversed(list(enumerate(pages))):
        out += [obj(10 + 2 * i, f"<< /Type /Page /Parent 3 0 R /Contents {11 + 2 * i} 0 R >>"), obj(11 + 2 * i, stream(p, packed))]
    return b"%PDF-1.4\n" + b"".join(out) + b"%%EOF"


def test_pages():
    one = rb"BT /F1 12 Tf 72 700 Td (Hello \(big\) w\157rld) Tj 0 -14 Td [(sec) 20 (ond) -300 (line)] TJ T* <486578> Tj ET"
    two = rb"BT /F2 9 Tf 10 10 Td <0041004200430044> Tj ET"
    for packed in (True, False):
        assert pdf.pdf_pages(document(one, b"", two, packed=packed)) == ["Hello (big) world\nsecond line\nHex", "", "Ωabc"]
    assert pdf.pdf_pages(None) == pdf.pdf_pages(b"no pdf") == []


def test_object_streams():
    bodies = [(1, b"<< /Type /Catalog /Pages 2 0 R >>"), (2, b"<< /Type /Pages /Kids [4 0 R] >>"), (4, b"<< /Type /Page /Contents [5 0 R] >>")]
    heads, at = [], 0
    for n, b in bodies:
        heads.append(f"{n} {at}")
        at += len(b) + 1
    head = (" ".join(heads) + " ").encode()
    packed = stream(head + b" ".join(b for _, b in bodies), more=f"/Type /ObjStm /N 3 /First {len(head)} ")
    content = b"%PDF-1.5\n" + obj(3, packed) + obj(5, stream(rb"BT (inside) Tj ET"))
    assert pdf.pdf_pages(content) == ["inside"]


def test_rows(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(document(b"BT (first) Tj ET", b"", b"BT (third) Tj ET"))
    (tmp_path / "b.pdf").write_bytes(b"broken")
    got = pdf.pdf_rows(readers.payloads(spark, f"{tmp_path}/*.pdf")).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["slide_number"], r["text"]) for r in got) == [("a.pdf", 1, "first"), ("a.pdf", 3, "third")]
