"""Personal data, benchmark leaks and tool calls against plain versions."""

import hashlib
import json
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from clearspark.llm import decontamination, personal_data, tool_calls, tool_messages
from tests.llm.cases import empty_table, odd_rows, odd_table, prose, words

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    each = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in each) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    return {"email": True, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check_base(found, texts):
    for r in found:
        own = base_spans(texts[r.doc_id])
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == [f"{k}:{a}:{b}" for k, a, b in own]
        assert r.base_sha256 == hashlib.sha256(joined(own).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in own) for k in PATTERNS]


def test_base_spans_match_the_patterns(spark):
    pieces = ["1", "2", "255", "256", "00", ".", "..", "@", "a", "b.c", "_", "-", " ", "  ", "+", "(", ")", "4539148803436467",
              "4539 1488 0343 6467", "é", "𝒳", "user@mail.com", "10.0.0.1", "+49 30 1234567", ",", "\n"]
    rng = random.Random(5)
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(1500)]
    texts += [None, "", "1 " * 9000, "a." * 9000 + "@x", "a@b" + ".c" * 9000, "1." * 9000, "+1" * 5000, "+1" + " " * 9000, "9" * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_base(personal_data.find(docs, ["doc_id"]).collect(), texts)


def test_base_spans_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check_base(personal_data.find(docs, ["doc_id"]).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_terms_that_reveal_an_entity(spark):
    rows = [f"{prose(i, 40)} Contact Marwenna at m.k@mail.org for the rest {prose(100 + i, 40)}" for i in range(3)]
    rows += [f"{prose(i, 60)} for the rest Contact at desk{i}@mail.org {prose(i + 50, 9)}" for i in range(200, 260)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r for r in personal_data.find(docs, ["doc_id"]).collect()}
    for i, text in enumerate(rows):
        terms = [text[int(a) : int(b)] for k, a, b in (s.split(":") for s in found[i].spans.split(",")) if k == "term"]
        assert ("Marwenna" in terms) == (i < 3) and "Contact" not in terms and "rest" not in terms
    masked = {r.doc_id: r.text for r in personal_data.sanitise(docs).collect()}
    assert "Contact <TERM> at <EMAIL> for the rest" in masked[0] and "Marwenna" not in "".join(masked.values())


def test_terms_are_found_and_masked_wherever_they_stand(spark):
    far = "of the and " * 30
    rows = [f"Quillon {prose(i, 9)} {far} write to q.x@mail.org {far} so Quillon said quillon@host.org" for i in range(3)]
    rows += ["Here is Quillon alone"] + [f"the rest of {prose(100 + i, 50)} and so to write" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r for r in personal_data.find(docs, ["doc_id"]).collect()}
    for i, text in enumerate(rows):
        terms = [(int(a), text[int(a) : int(b)]) for k, a, b in (s.split(":") for s in found[i].spans.split(",") if s) if k == "term"]
        assert [a for a, t in terms if t == "Quillon"] == [m.start() for m in re.finditer("Quillon", text)]
        assert not {"write", "the", "quillon", "host"} & {t for _, t in terms}
    masked = {r.doc_id: r.text for r in personal_data.sanitise(docs).collect()}
    assert masked[3] == "Here is <TERM> alone" and "Quillon" not in "".join(masked.values()) and len(masked) == len(rows)


def test_sanitised_odd_rows(spark):
    docs = odd_table(spark)
    found = personal_data.sanitise(docs)
    assert found.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(map(tuple, found.collect()), key=key) == sorted(odd_rows(), key=key)
    assert personal_data.sanitise(empty_table(spark)).count() == 0 and personal_data.find(empty_table(spark), ["doc_id"]).count() == 0
    two = spark.createDataFrame([(1, "call +49 30 1234567 or ip 10.0.0.1, x@y.zz", "a", "b")], "doc_id long, text string, _a string, leaks string")
    assert personal_data.sanitise(two.drop("_a")).first().text == "call <PHONE> or ip <IP>, <EMAIL>"


def plain_scores(texts, items):
    """BM25 shares of every item for a passage's distinct words."""
    own = [words(t) for t in items]
    mean = sum(map(len, own)) / len(own)
    df = Counter(w for o in own for w in set(o))

    def weight(w, o):
        tf = o.count(w)
        return math.log(1 + (len(own) - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(o) / mean))

    for text in texts:
        asked = set(words(text))
        yield [sum(weight(w, o) for w in set(o) & asked) / sum(weight(w, o) for w in set(o)) for o in own]


def test_wand_finds_all_items_above_the_threshold():
    items = [prose(i, 12 + i % 30, 300) for i in range(90)]
    terms = decontamination.words_of(items)
    df = Counter(h for a, b in zip(terms.firsts, terms.firsts[1:], strict=False) for h in set(terms.hashes[a:b].view(np.int64).tolist()))
    mean = len(terms.hashes) / len(items)
    passages = [prose(1000 + i, 60, 300) for i in range(40)] + [prose(5, 30) + " " + items[i] + " " + prose(6, 20) for i in range(0, 90, 7)]
    for threshold in (0.2, 0.4, 0.8):
        index = decontamination.build(list(range(90)), items, df, len(items), mean, threshold)
        for text, scores in zip(passages, plain_scores(passages, items), strict=True):
            at = decontamination.find(index.hashes, np.unique(decontamination.words_of([text]).hashes))
            found = dict(index.search(at[at >= 0]))
            assert set(found) == {i for i, s in enumerate(scores) if s >= threshold - 1e-9}
            assert all(abs(found[i] - scores[i]) < 1e-9 for i in found)


def test_leaks_in_long_texts_and_no_others(spark):
    items = [(i, prose(i, 15 + i, 3000) + ". " + prose(500 + i, 6, 3000) + ".") for i in range(40)]
    rng = random.Random(2)
    docs, expected = [], set()
    for i in range(120):
        text = prose(1000 + i, 200 + 40 * (i % 9), 3000)
        if i % 3 == 0:
            cut = rng.randrange(len(text))
            text = f"{text[:cut]} {items[i % 40][1]} {text[cut:]}"
            expected.add((i, i % 40))
        docs.append((i, text))
    benchmark = spark.createDataFrame([*items, (100, None), (101, ""), (102, "too short")], "item_id long, text string")
    for most in (50_000, 15):
        rows = decontamination.with_leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark, ["doc_id"], most=most).collect()
        assert {(r.doc_id, x.item_id) for r in rows for x in r.leaks} == expected
        assert len(rows) == 120 and all(x.overlap > 0.7 and x.score >= 0.99 for r in rows for x in r.leaks)


def test_leaks_of_odd_rows(spark):
    items = spark.createDataFrame([(1, prose(2, 60)), (2, prose(8, 30))], "item_id long, text string")
    found = decontamination.with_leaks(odd_table(spark), items, keep=["doc_id"]).collect()
    assert len(found) == len(odd_rows())
    assert {r.doc_id for r in found if r.leaks} == {7}
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.leaks for r in decontamination.with_leaks(odd_table(spark), none, keep=["doc_id"]).collect())
    assert decontamination.with_leaks(empty_table(spark), items, keep=["doc_id"]).count() == 0


def test_leaks_are_found_from_texts_alone(spark):
    items = spark.createDataFrame([(i, prose(2 + i, 30)) for i in range(6)], "item_id long, text string")
    for most in (50_000, 2):
        found = decontamination.with_leaks(odd_table(spark), items, into="content", most=most).filter("size(content) < 9")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == (1 if most > 6 else 3) and "MapInArrow" not in plan
        assert found.columns == [*odd_table(spark).columns, "content"]
        plain = [tuple(map(str, r[:-1])) for r in found.collect()]
        assert sorted(plain) == sorted(tuple(map(str, r)) for r in odd_table(spark).collect())


def call(key, name="search", arguments='{"query":"x","limit":3}', after=()):
    return {"id": key, "name": name, "arguments": arguments, "after": list(after)}


def message(conv, turn, *calls, to=None, content=None):
    if calls:
        return (conv, turn, "assistant", json.dumps({"tool_calls": calls}))
    return (conv, turn, "tool", json.dumps({"tool_call_id": to, "content": content}))


def test_calls_are_linked_ordered_and_checked(spark):
    rows = [
        message("a", 1, call("x"), call("y", after=["x"])), message("a", 2, to="x", content="1"), message("a", 3, to="x", content="2"),
        message("a", 4, call("x"), call("z", after=["y", "x", "gone"])), message("a", 5, to="y", content="3"), message("a", 0, to="z", content="early"),
        message("a", 9, to="nobody", content="?"), message("b", 1, call("p", after=["q"]), call("q", after=["p"]), call("r", after=["q"])),
        message(None, 1, call("x", "other"), call("v", arguments="{"), call("w", arguments='{"limit":99.0,"extra":1}')),
        message("c", 1, call(None, arguments='{"limit":2.0,"query":"é"}')), ("c", 2, "tool", "plain"), ("c", 3, None, None), ("d", None, "assistant", ""),
    ]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id string, turn long, role string, text string, level int")
    found = {(r.conv, r.turn, r.position, r.id): r for r in tool_calls.link(table, tool_messages.SCHEMAS).collect()}
    shown = {k: (r.status, r.level, r.result_turn, r.results) for k, r in found.items()}
    assert shown == {
        ("a", 1, 0, "x"): ("ok", 0, 2, 2), ("a", 1, 1, "y"): ("ok", 1, 5, 1), ("a", 4, 0, "x"): ("repeated", None, None, 0),
        ("a", 4, 1, "z"): ("unanswered", 2, None, 0), ("a", 0, 0, "z"): ("orphan", None, 0, 1), ("a", 9, 0, "nobody"): ("orphan", None, 9, 1),
        ("b", 1, 0, "p"): ("circular", None, None, 0), ("b", 1, 1, "q"): ("circular", None, None, 0), ("b", 1, 2, "r"): ("circular", None, None, 0),
        (None, 1, 0, "x"): ("invalid", 0, None, 0), (None, 1, 1, "v"): ("invalid", 0, None, 0), (None, 1, 2, "w"): ("invalid", 0, None, 0),
        ("c", 1, 0, None): ("unanswered", 0, None, 0),
    }
    assert found[None, 1, 2, "w"].faults == [".query: missing", ".extra: unknown", ".limit: above 20"]
    assert found["c", 1, 0, None].message == '{"after":[],"arguments":{"limit":2,"query":"é"},"id":null,"name":"search","result":null}'
    assert tool_calls.link(table.filter("false"), tool_messages.SCHEMAS).count() == 0


def test_a_message_given_three_times_gives_its_calls_three_times(spark):
    rows = [message("a", 1, call("x"), call("y", after=["x"])), message("a", 2, to="x", content="1"), message(None, 1, call("x"), call("v"))]
    other = message("a", 1, call("x", after=["y"]))
    table = lambda rows: spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    found = Counter((r.conv, r.id, r.level, r.status) for r in tool_calls.link(table(rows * 3), tool_messages.SCHEMAS).collect())
    assert found == {
        ("a", "x", 0, "ok"): 3, ("a", "y", 1, "unanswered"): 3, (None, "x", 0, "unanswered"): 3, (None, "v", 0, "unanswered"): 3,
    }
    found = Counter((r.conv, r.id, r.status) for r in tool_calls.link(table([*rows[:1], other, other]), tool_messages.SCHEMAS).collect())
    assert found == {("a", "x", "circular"): 3, ("a", "y", "circular"): 1}


def test_hostile_arguments_make_a_call_invalid(spark):
    deep = lambda n: '{"query":"a","limit":' + "[" * n + "]" * n + "}"
    given = ['{"query":"\\ud800","limit":1}', '{"query":"\\ud83d\\ude00","limit":1}', deep(3000), deep(100000), deep(150), "9" * 5000, '{"query":"a","limit":1e999}']
    rows = [message("a", i, call(f"x{i}", arguments=text)) for i, text in enumerate(given)]
    found = {r.turn: r for r in tool_calls.link(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"), tool_messages.SCHEMAS).collect()}
    assert [found[i].faults for i in range(7)] == [
        [".: no JSON"], [], [".: too deep"], [".: too deep"], [".limit: not integer"], [".: no JSON"], [".limit: not integer"],
    ]
    shown = [json.loads(found[i].message) for i in (0, 1, 3)]
    assert [m["arguments"] for m in shown] == [given[0], {"query": "\U0001f600", "limit": 1}, given[3]]
    assert all(list(m) == ["after", "arguments", "id", "name", "result"] for m in shown)


def test_a_chain_of_a_thousand_calls(spark):
    rows = [message("a", i, call(f"x{i}", after=[f"x{i - 1}"] if i else [])) for i in range(1000)]
    rows += [message("b", i, call(f"x{i}", after=[f"x{(i + 1) % 40}"])) for i in range(40)]
    started = time.time()
    found = tool_calls.link(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"), tool_messages.SCHEMAS).collect()
    assert time.time() - started < 60
    assert {(r.conv, r.turn): r.level for r in found} == {("a", i): i for i in range(1000)} | {("b", i): None for i in range(40)}


def test_levels_of_random_waits(spark):
    dice, calls = random.Random(5), {}
    for conv, back in (("dag", True), ("any", False), (None, True)):
        for i in range(60):
            ids = [f"x{j}" for j in (range(i) if back else range(60))]
            calls[conv, f"x{i}"] = dice.sample(ids, min(len(ids), dice.choice([0, 1, 1, 1, 2, 3]))) + ["nobody"]
    rows = [message(conv, int(i[1:]), call(i, after=after)) for (conv, i), after in calls.items()]
    expected, left = {}, dict(calls)
    while ready := {k for k, after in left.items() if all((k[0], d) in expected or (k[0], d) not in calls for d in after)}:
        expected |= {k: max((expected[k[0], d] + 1 for d in calls[k] if (k[0], d) in calls), default=0) for k in ready}
        left = {k: after for k, after in left.items() if k not in ready}
    found = tool_calls.link(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"), tool_messages.SCHEMAS).collect()
    assert {(r.conv, r.id): r.level for r in found} == {k: expected.get(k) for k in calls}
    assert 0 < len(left) < 60


def test_levels_of_a_table_of_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    messages = tool_messages.tool_messages(turns)
    calls = {}
    for r in messages.filter("role = 'assistant'").collect():
        for c in json.loads(r.text)["tool_calls"]:
            calls[r.conv_id, c["id"]] = [(r.conv_id, d) for d in c["after"]]

    def level(key, above=()):
        if key in above:
            return None
        below = [level(d, (*above, key)) for d in calls[key] if d in calls]
        return None if None in below else max((x + 1 for x in below), default=0)

    found = tool_calls.link(messages, tool_messages.SCHEMAS).filter("status <> 'orphan'").collect()
    assert {(r.conv, r.id): r.level for r in found} == {k: level(k) for k in calls}


@pytest.mark.parametrize(
    ("value", "schema", "expected"),
    [
        (3.0, {"type": "integer"}, []),
        (True, {"type": "integer"}, [".: not integer"]),
        ([1, "a"], {"type": "array", "items": {"type": "number"}}, ["[1]: not number"]),
        (None, {"type": ["string", "null"]}, []),
        ("x", {"enum": ["a", "b"]}, [".: not listed"]),
        ({"a": {"b": -1}}, {"properties": {"a": {"properties": {"b": {"minimum": 0}}}}}, [".a.b: below 0"]),
    ],
)
def test_schema_faults(value, schema, expected):
    assert tool_calls.faults(value, schema) == expected
