"""Secret spans against Python's own regular expressions, against SQL, and by owner."""

import hashlib
import re

from cases import AWKWARD, SMALL
from compare import connect, difference

from feedloom.llm import ownership
from feedloom.llm.oracles import ORACLES
from feedloom.llm.queries import QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return ",".join(f"{k}:{a}:{z}" for a, _, z, k in sorted(found))


KEY = "AKIA" + "Q7ZR4M2K9T1XW8PA"
HEX = "0123456789abcdef" * 2
OPAQUE = "zX9kQ2vB7nM4pL8sD1wE6rT3"
ROWS = [
    (1, f"é token=abcdef {KEY} and {HEX}", "a"),
    (2, "secret=token: abcdefgh secret: a token= 'abcdef' API_KEY:=x apikey=\"A.b-c/d+e\"", "a"),
    (3, f"{KEY[:19]} AKIA{KEY} {HEX[:23]} x{HEX}x", "b"),
    (4, f"example {OPAQUE}Example0 here", "a"),
    (5, f"example {OPAQUE}Example0 there", "b"),
    (6, f"example {OPAQUE}Example0 everywhere", "c"),
    (7, f"mine: {OPAQUE}Own1", "c"),
    (8, "Password = hunter2hunter2", None),
    (9, None, "a"),
    (10, "", "a"),
    (None, f"no id, token={HEX}", "a"),
    (11, "token=abcdef " * 300, "a"),
]


def test_base_spans_agree_with_regular_expressions(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in ownership.digest_of(ownership.scan(docs)).collect()}
    assert len(found) == len(ROWS)
    for doc_id, text, _ in ROWS:
        assert found[doc_id]["base_sha256"] == hashlib.sha256(base_spans(text or "").encode()).hexdigest(), doc_id


def test_owners_tell_examples_from_live_values(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in ownership.digest_of(ownership.scan(docs)).collect()}
    assert all("opaque" not in found[i]["spans"] for i in (4, 5, 6))
    assert "opaque:6:" in found[7]["spans"] and found[7]["n_live"] == 1
    assert found[8]["n_live"] == 1 and found[9]["spans"] == ""


def test_redaction_hides_live_values_and_keeps_examples(spark):
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], "doc_id long, text string, source string, n_chars long")
    out = {r["doc_id"]: r for r in ownership.redact(docs).collect()}
    assert out[9]["text"] is None and out[10]["text"] == ""
    assert out[1]["text"] == "é [SECRET] [SECRET] and [SECRET]"
    assert OPAQUE in out[4]["text"] and OPAQUE not in out[7]["text"]
    assert out[7]["n_chars"] == len(out[7]["text"])
    assert HEX not in out[None]["text"]


def test_repeated_and_awkward_rows(texts):
    docs = texts([*AWKWARD, (4, "token=abcdefgh"), (4, "token=abcdefgh")])
    rows = ownership.digest_of(ownership.scan(docs)).collect()
    assert len(rows) == len(AWKWARD) + 2
    assert sum(r["n_assign"] for r in rows) == 2
    assert ownership.scan(texts([])).count() == 0 and ownership.redact(docs).count() == len(AWKWARD) + 2


def test_agrees_with_sql(spark):
    assert difference(QUERIES["op9_secret_owners"](spark, SMALL), connect(SMALL), ORACLES["op9_secret_owners"]) == ""


def test_no_python_on_the_rows(spark):
    shown = QUERIES["op9_secret_owners"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in shown and "Arrow" not in shown
