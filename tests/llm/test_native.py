"""Mixing, secret scans and Merkle trees against plain Python."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from hearthgrid.llm import merkle, mixing, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, "one two"), (4, "x" * 50_000), (5, "one two"), (5, "one two"), (None, "null id"), (7, "é 😀\n\npassword: abcdef\n"), (8, "😀 x")]


def test_targets_stop_at_twice_the_size(docs):
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a"] * 30 + ["b"] * 3 + ["c"] * 3 + [None] * 2)]
    out = mixing.digest(docs(rows)).collect()
    by = defaultdict(lambda: [0, 0, 0.0])
    source = dict((r[0], r[2]) for r in rows)
    for r in out:
        assert r["taken"] <= 2 * r["size"]
        x = by[source[r["doc_id"]]]
        x[0] += r["size"]
        x[1] += r["taken"]
        x[2] = r["target"]
    assert abs(sum(x[2] for x in by.values()) - 1.5 * 380) < 1e-6
    assert all(x[2] <= 2 * x[0] and abs(x[1] - x[2]) < 1 for x in by.values())
    assert by["c"][2] == 60 and by[None][2] == 40  # weights 2 and 3 of small sources end at their limit


def test_mixing_odd_rows_and_positions(docs):
    data = docs([(*r, "a") for r in ODD])
    first, second = mixing.digest(data).collect(), mixing.digest(data.repartition(3)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], r["position"] or -1)
    assert sorted(map(key, first)) == sorted(map(key, second)) and len(first) == len(ODD)
    sequence = mixing.curriculum(mixing.mix(mixing.sized(data.withColumnRenamed("lang", "target")))).collect()
    assert [r["position"] for r in sequence] == sorted(r["position"] for r in sequence)
    assert mixing.digest(docs([])).collect() == []


def test_sources_without_words(docs):
    data = docs([(1, "one two three", "x"), (2, "", "y"), (3, None, "y"), (4, " \n", None)])
    got = {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"], r["position"]) for r in mixing.digest(data).collect()}
    assert got[2] == got[3] == got[4] == (0, 0, 0.0, 0, None) and got[1][3] == 4
    assert [r["doc_id"] for r in mixing.stage(data).collect()] == [1, 1]
    empty = docs([(1, "", "x"), (2, None, None)])
    assert [(r["target"], r["taken"]) for r in mixing.digest(empty).collect()] == [(0.0, 0)] * 2 and mixing.stage(empty).collect() == []


def test_schedule_is_inverted(spark):
    from pyspark.sql import functions as F

    for knots in (*mixing.SCHEDULES, ((0.0, 1.0), (0.5, 0.0), (1.0, 3.0))):
        got = spark.range(11).select((F.col("id") / 10).alias("y")).select("y", mixing.inverse(knots, F.col("y")).alias("t")).collect()
        for y, t in got:
            area = 0.0
            for (a, v), (b, w) in zip(knots, knots[1:]):
                x = min(max(t, a), b)
                area += (x - a) * (v + v + (w - v) * (x - a) / (b - a)) / 2
            assert abs(area - y * mixing.integral(knots)) < 1e-9


def plain_base(text):
    out = []
    for number, (kind, pattern, group, least) in enumerate(
        [
            ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20),
            ("hex", r"[0-9a-f]+", 0, 24),
        ]
    ):
        out += [(m.start(), number, kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return sorted(out)


def check_base(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        want = [plain_base(t or "") for i, t in texts if i == r["doc_id"]]
        shown = [",".join(f"{k}:{s}:{e}" for s, _, k, e in w) for w in want]
        assert r["base_sha256"] in {hashlib.sha256(w.encode()).hexdigest() for w in shown}
        if r["n_linked"] == 0:
            assert r["spans"] in shown


def test_base_secrets(docs, corpus):
    texts = [
        *ODD,
        (20, "password=token : xyz1234 PASSWD='aaaaaa' token=ab api_key:\"q-1.2=3\""),
        (21, "😀AKIA" + "A" * 16 + "-AKIAAKIA" + "B" * 11 + " " + "0f" * 12 + "g" + "0" * 23),
        (22, "secret=" + "ab12" * 10 + "password=" * 3),
    ]
    check_base(secrets.digest(docs(texts)).collect(), texts)
    whole = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    check_base(secrets.digest(corpus).collect(), whole)
    assert secrets.digest(docs([])).collect() == []


def test_spans_of_many_matches_and_scopes(docs):
    """As many matches as a text of megabytes has: work must not grow with their square."""
    many = "token=abcdef\n" * 200_000
    texts = [(1, many), (2, "\n\n".join(f"client_id=u{i} 😀 secret=hunter{i % 10}2" for i in range(700)) + "\n\nclient_id=alone")]
    got = {r["doc_id"]: r for r in secrets.digest(docs(texts)).collect()}
    assert got[1]["n_assign"] == 200_000
    check_base([got[1]], texts[:1])
    spans = [s.split(":")[0] for s in got[2]["spans"].split(",")]
    assert spans == ["ident", "assign"] * 700


def test_weak_parts_need_each_other(docs):
    who, what, where = "AKIA" + "Z9" * 10, "opaqueTok3n" * 3, "https://db.internal/x"
    texts = [(1, what), (2, where), (3, f"{who} {what} {where}"), (4, f"{who}\n\n{what}"), (5, f"{who}{' ' * 400}{what}"), (6, "client_id=abc"), (7, "client_id=abc password=hunter22")]
    spans = {r["doc_id"]: [s.split(":")[0] for s in r["spans"].split(",") if s] for r in secrets.digest(docs(texts), window=256).collect()}
    assert spans == {1: [], 2: [], 3: ["access", "opaque", "endpoint"], 4: ["access"], 5: ["access"], 6: [], 7: ["ident", "assign"]}


@pytest.mark.parametrize("window", [256, None])
def test_long_parts_link(docs, window):
    """Slots are of starts alone: parts longer than the window met only by luck."""
    where, long = "https://db.internal/x", "password=" + "x" * 711
    who, wide = "client_id=abc", "https://db.internal/" + "y" * 700
    texts = [(1, f"{long}{' ' * 10}{where} client_id=abc"), (2, f"{who} password=hunter22 {wide}"), (3, f"{wide}{' ' * 10}{who} password=hunter22"), (4, f"client_id=abc {long}0{'=' * 40}")]
    spans = {r["doc_id"]: [s.split(":")[0] for s in r["spans"].split(",") if s] for r in secrets.digest(docs(texts), window).collect()}
    assert spans == {1: ["assign", "endpoint", "ident"], 2: ["ident", "assign", "endpoint"], 3: ["endpoint", "ident", "assign"], 4: ["ident", "assign"]}


def test_opaque_by_an_endpoint_that_has_an_identifier(docs):
    who, what, where = "client_id=abc", "opaqueTok3n" * 3, "https://db.internal/x"
    pad = " " * 200
    texts = [(1, f"{who}{pad}{where}{pad}{what}"), (2, f"{pad}{where}{pad}{what}"), (3, f"{who}{pad * 2}{where}{pad}{what}"), (4, f"{who}{pad}{where}\n\n{pad}{what}")]
    spans = {r["doc_id"]: [s.split(":")[0] for s in r["spans"].split(",") if s] for r in secrets.digest(docs(texts), window=256).collect()}
    assert spans == {1: ["endpoint", "opaque"], 2: [], 3: [], 4: []}


def plain_weak(text):
    """Weak spans of a text by comparing all parts of each scope."""
    kinds = [(secrets.ASSIGN, 2, 6), (secrets.ACCESS, 0, 20), (secrets.HEX, 0, 24), (secrets.IDENT, 1, 1), (secrets.OPAQUE, 0, 16), (secrets.ENDPOINT, 0, 1)]
    cuts = [m.start() for m in re.finditer(secrets.BLANK, text)]
    parts = []
    for number, (pattern, group, least) in enumerate(kinds):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least and (number != 4 or re.search("[0-9]", m.group()) and re.search("[A-Za-z]", m.group())):
                parts.append((m.start(), m.end(), number, sum(x < m.start() for x in cuts)))
    if not any(p[2] in (1, 3, 5) for p in parts):
        return []
    role = lambda p: "who" if p[2] in (1, 3) else "where" if p[2] == 5 else "what"
    out = []
    for p in parts:
        same = [q for q in parts if q[3] == p[3]]
        over = [q for q in same if q[0] < p[1] and p[0] < q[1]]
        roles = {role(q) for q in same if q not in over}
        if p[2] < 3 or any(q[2] < 3 or p[2] == 4 and q[2] == 5 for q in over):
            continue
        if {3: "what" in roles, 4: "who" in roles, 5: {"who", "what"} <= roles}[p[2]]:
            out.append((p[0], secrets.KINDS[p[2]], p[1]))
    return sorted(out)


def test_scopes_link_whatever_the_distance(docs, corpus):
    draw = random.Random(9)
    pieces = ["client_id=abc", "account_id: x.y", "https://db.internal/x", "opaqueTok3n" * 3, "password=hunter22", "AKIA" + "Z9" * 10, "0f" * 14, "user=jo", "id=opaqueTok3nopaqueTok3n", "https://h/opaqueTok3nopaqueTok3n9", "😀", "\n\n", "\n \t\n"]
    texts = [(i, "".join(draw.choice(pieces) + draw.choice([" ", "\n", ", ", " " * 400]) for _ in range(draw.randrange(1, 14)))) for i in range(300)]
    texts += [(r["doc_id"] + 1000, r["text"]) for r in corpus.collect()]
    got = {r["doc_id"]: r["spans"] for r in secrets.digest(docs(texts)).collect()}
    found = 0
    for i, text in texts:
        weak = [s for s in got[i].split(",") if s and s.split(":")[0] in secrets.KINDS[3:]]
        want = [f"{k}:{a}:{b}" for a, k, b in plain_weak(text or "")]
        assert sorted(weak) == sorted(want), (i, text)
        found += len(want)
    assert found > 200


def test_secrets_leave_the_texts(docs):
    data = docs([(1, "a password=hunter22 b"), (2, "clean"), (3, None), (1, "a password=hunter22 b")])
    out = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in secrets.stage(data).collect() if r["text"])
    assert out == [(1, "a [secret] b", 12), (1, "a [secret] b", 12), (2, "clean", 5)]
    assert secrets.stage(data).columns == data.columns


def test_merkle(docs, corpus, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 40)
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    ordered = sorted(rows, key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in merkle.digest(corpus).collect()}
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["n_chars"] == len(text)
        assert (got[i]["fingerprint"] == got[i]["edited_fingerprint"]) == (text == edited)
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    prints = defaultdict(set)
    for i, text in rows:
        prints[text].add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len(set().union(*prints.values())) == len(prints)


def test_merkle_odd_rows(docs):
    out = merkle.digest(docs(ODD)).collect()
    assert len(out) == len(ODD) and all(r["fingerprint"] for r in out)
    one = merkle.digest(docs([(1, None)])).collect()[0]
    assert one["near_next"] == 1.0 and one["n_chars"] == 0
    assert merkle.digest(docs([])).collect() == []


def test_changed_branches(spark):
    from pyspark.sql import functions as F

    a, b = "p\nq\n\nr\ns", "p\nq\n\nr\nS\nt"
    row = spark.range(1).select(merkle.changed(merkle.sections(F.lit(a)), merkle.sections(F.lit(b))).alias("c")).first()
    assert row["c"] == [3, 4]
