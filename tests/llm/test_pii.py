"""Personal data: base spans against plain patterns, revealing terms against SQL and by planted cases."""

import hashlib
import re

import duckdb
import pandas as pd
import pytest

from lodestone.llm import exact_dedup, pii, queries

SCHEMA = "doc_id long, text string, spans string, term string, __row string, n_chars long"
KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
CARD = "4111 1111-1111 1111"
AWKWARD = [
    None,
    "",
    "no data at all in this text",
    "a@b.c_d@e.f, a@b..c x@y.z. @q.r a@b.c@d.e %+-@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 0000.0.0.1 1.2.3 99999999999999999999.1.1.1 ٣.٤.٥.٦",
    f"{CARD} and {CARD}5 411111111111111 4111111111111112 4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1 41  11 {'7' * 30}",
    "+44 (0) 20 7946 0958 +1-800 +1 (((( +999999999 +1234567890123456 ++12.34.56.78.90-",
    "😀 é+1 222 333 444 5@x.yz 日本 10.0.0.1@host.example 4111111111111111@card.example",
    "x" * 60_000 + "@ " + "1-" * 30_000 + " " + "9.9." * 20_000 + " " + "+1(" * 20_000,
    "long " * 40_000 + "end@mail.example.com " + "tail " * 100,
]


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    found = []
    for k, (name, pattern) in enumerate(KINDS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if name == "ip" else True,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[name]
            if fits:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def frame(spark, texts):
    return spark.createDataFrame([(k, t, "clash", "term", "row", None if t is None else len(t)) for k, t in enumerate(texts)], SCHEMA).repartition(3)


def report(docs):
    return pii.span_report(pii.private_spans(exact_dedup.numbered(docs.drop("__row")))).collect()


def test_base_spans(spark):
    plain = [t for t in AWKWARD if t is None or len(t) < 1000] + ["long " * 4000 + "end@mail.example.com " + "tail " * 100]
    got = {r.doc_id: r for r in report(frame(spark, plain))}
    for k, t in enumerate(plain):
        want = base_spans(t)
        said = ",".join(f"{KINDS[x][0]}:{a}:{b}" for a, x, b in want)
        assert got[k].base_sha256 == hashlib.sha256(said.encode()).hexdigest(), (t, said, got[k].spans)
        assert [got[k][f"n_{name}"] for name, _ in KINDS] == [sum(x == i for _, x, _ in want) for i in range(4)]


def test_long_runs_take_linear_time(spark):
    got = {r.doc_id: r for r in report(frame(spark, AWKWARD))}
    assert got[9].n_email == 1 and got[9].spans.startswith("email:200000:")
    assert got[8].n_email == got[8].n_card == got[8].n_phone == 0


def revealing():
    """Texts in which `zebrafish` and `kestrel` stand with one address almost only, `common` everywhere, `copied` in copies of one text."""
    texts = [f"common words number {'abcdefghij'[k % 10]} about nothing much" for k in range(600)]
    texts += [f"{w} Zebrafish keeper ann@mail.example.com common {w}" for w in ("early", "later", "never")]
    texts += ["kestrel again", "kestrel once", "kestrel there", "kestrel here"]
    texts += [f"{w} Kestrel ann@mail.example.com" for w in ("upper", "lower")]
    texts += ["copied heron bob@mail.example.com copied heron"] * 4
    texts += ["zebrafish without an address", "x" * 100 + "cutoff" + " y" * 30 + " ann@mail.example.com" + "z" * 70]
    texts += ["+44 20 7946 0958 zebrafish@mail.example.com ann@mail.example.com"]
    return texts


def test_revealing_terms(spark):
    texts = revealing()
    got = {r.doc_id: r.spans for r in report(frame(spark, texts))}
    said = lambda k: [(s.split(":")[0], texts[k][int(s.split(":")[1]) : int(s.split(":")[2])]) for s in got[k].split(",") if s]
    assert said(600) == [("general", "Zebrafish"), ("remove", "keeper"), ("email", "ann@mail.example.com")] and "common" not in [w for _, w in said(600)]
    assert said(607)[0] == ("general", "Kestrel")
    assert [k for k, _ in said(609)] == ["email"]
    assert got[0] == got[603] == got[613] == ""


@pytest.mark.parametrize("texts", [AWKWARD[:8], revealing()])
def test_equals_sql(spark, texts):
    con = duckdb.connect()
    table = pd.DataFrame({"doc_id": range(len(texts)), "text": pd.Series(texts, dtype=object)})
    con.register("documents", table)
    rel = con.sql(queries.OP13_SQL)
    got = {r.doc_id: r.asDict() for r in report(frame(spark, texts))}
    want = {r[0]: dict(zip(rel.columns, r, strict=True)) for r in rel.fetchall()}
    assert got == want


def test_sanitised(spark):
    texts = revealing()
    docs = frame(spark, [*texts, None, f"é {CARD}, +44 20 7946 0958. ok"])
    got = {r.doc_id: r for r in pii.sanitised(docs).collect()}
    assert pii.sanitised(docs).columns == docs.columns
    assert got[600].text == "early [TERM]  [EMAIL] common early"
    assert got[607].text.startswith("upper [TERM] [EMAIL]")
    assert got[0].text == texts[0] and got[len(texts)].text is None
    assert got[len(texts) + 1].text == "é [CARD], [PHONE]. ok"
    assert all(r.text is None or r.n_chars == len(r.text) for r in got.values())


def test_no_rows(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert report(nothing) == []
    assert pii.sanitised(nothing).count() == 0


def test_a_hot_entity(spark):
    rows = spark.range(3000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, concat('word', chr(97 + id % 26), chr(97 + (id div 26) % 26), ' flamingo help@desk.example ok'), 'plain words') as text"
    )
    got = pii.span_report(pii.private_spans(exact_dedup.numbered(rows)))
    assert got.where("n_email = 1").count() == 1000
    assert got.where("spans like 'remove:7:15,email%'").count() == 1000
