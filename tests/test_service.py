"""The HTTP service: health, uploads, pages."""

import json
import threading
import urllib.error
import urllib.request

import pytest
from examloom import service

from test_pdf import written


@pytest.fixture
def served(spark, tmp_path):
    http = service.server(spark, "127.0.0.1", 18765, str(tmp_path))
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{http.server_port}", http.server_port
    http.shutdown()
    http.server_close()


def get(url):
    try:
        with urllib.request.urlopen(url) as r:
            return r.status, r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode()


def upload(url, fields, files):
    parts = [f'--x\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in fields.items()]
    parts += [f'--x\r\nContent-Disposition: form-data; name="{k}"; filename="{name}"\r\nContent-Type: application/pdf\r\n\r\n'.encode() + body + b"\r\n" for k, (name, body) in files.items()]
    return get(urllib.request.Request(url, b"".join(parts) + b"--x--\r\n", {"Content-Type": "multipart/form-data; boundary=x"}))


def test_service(served):
    url, port = served
    assert service.free_port("127.0.0.1", port) != port
    assert get(f"{url}/health") == (200, '{"status": "ok"}') and get(f"{url}/none")[0] == 404
    question = b"BT /F1 10 Tf 77 700 Td (1 Which metal is extracted by electrolysis?) Tj " + b" ".join(b"1 0 0 1 101 %d Tm (%s metal %d) Tj" % (660 - 20 * i, b"ABCD"[i : i + 1], i) for i in range(4)) + b" ET"
    key = b"BT /F1 10 Tf 77 700 Td (Answers) Tj 0 -20 Td (1 C) Tj ET"
    files = {"question_pdf": ("q.pdf", written([question])), "answer_pdf": ("a.pdf", written([key]))}
    assert upload(f"{url}/ingest/mcq", {}, {"question_pdf": ("q.txt", b"x")})[0] == 400
    assert upload(f"{url}/ingest/mcq", {"run_id": "../x"}, files)[0] == 400 and upload(f"{url}/ingest/mcq", {"year": "soon"}, files)[0] == 400
    code, body = upload(f"{url}/ingest/mcq", {"run_id": "first", "year": "2023", "expected_question_count": "1"}, files)
    told = json.loads(body)
    assert code == 200 and told["ok"] and told["run_id"] == "first" and [s["stage"] for s in told["stages"]] == ["parse_questions", "parse_answers", "match", "validate"]
    assert "first" in get(url)[1] and "Which metal is extracted by electrolysis?<td>C<td>DRAFT" in get(f"{url}/first")[1]
