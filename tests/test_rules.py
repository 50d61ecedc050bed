"""Truth tables of the rule dialect, and a row interpreter against the compiled SQL."""

import random
import re

import pytest

from emberlog.operators.match import tag_events
from emberlog.functions.events import dumps, flatten
from emberlog.plans.rules import RAW_EVENT, Atom, Every, FieldMapping, Not, RuleNotSupported, Some, has_wildcard, load_filters, load_mapping, load_rules, parse_rule
from emberlog.plans.sql import used_fields, wildcard_pattern


def rule(detection, rule_id="r", **kw):
    return parse_rule("detection:\n" + "\n".join("  " + x for x in detection.split("\n")), rule_id, **kw)


def hits(spark, detection, events, mapping=None, filters=()):
    rows = [(i, e if isinstance(e, str) else dumps(e)) for i, e in enumerate(events)]
    df = spark.createDataFrame(rows, "i int, value string")
    out = tag_events(df, [rule(detection)], [rule(f, f"f{i}") for i, f in enumerate(filters)], FieldMapping(mapping)).collect()
    found = {r.i: bool(r.sigma_rule_ids) for r in out}
    return [found.get(i) for i in range(len(events))]


E = [("value1", "test", "test", True), ("test", "value2", "test", True), ("test", "value2", "filtered_value", False), ("value1", "value2", "filtered_value", True), ("test", "test", "test", False)]


def test_condition(spark):
    events = [{"field1": a, "field2": b, "field3": c} for a, b, c, _ in E]
    got = hits(spark, "selection1: {field1: value1}\nselection2: {field2: value2}\nfilter: {field3: filtered_value}\ncondition: selection1 or (selection2 and not filter)", events)
    assert got == [e[3] for e in E]


@pytest.mark.parametrize("value,negated,expected", [
    ("null", False, [True, True, True, False, False]), ("''", False, [True, True, True, False, False]), ("null", True, [False, False, False, True, True]),
    ("value1", False, [False] * 5), ("value1", True, [True] * 5),
])
def test_null_and_empty(spark, value, negated, expected):
    events = [{"field1": None}, {"field1": ""}, {"x": 1}, {"field1": "test"}, {"field1": "NULL"}]
    assert hits(spark, f"s: {{field1: {value}}}\ncondition: {'not ' * negated}s", events) == expected


@pytest.mark.parametrize("value,yes,no", [
    ("a*c", ["abc", "abdc", "ac", "ABC"], ["abcd", "dabc", "a\nc", "abc\n"]), ("a?c", ["abc", "a\rc"], ["abdc", "ac"]), ("a*c?e", ["abcde", "acde"], ["abcd", "abce"]),
    (r"a\*c", [r"a\*c"], ["abc", r"a\\*c", "a*c"]), ("a*c[de]", ["abc[de]"], ["abcd"]), (r"*\cmd.exe", ["xcmd.exe", "cmd.exe"], ["cmdxexe"]), ("a\tb*", [r"a\tbx"], ["a\tbx"]), ("*.*", ["x.y"], ["xy"]),
])
def test_wildcards(spark, value, yes, no):
    events = [{"f": v} for v in yes + no]
    assert hits(spark, f"s: {{f: {dumps(value)}}}\ncondition: s", events) == [True] * len(yes) + [False] * len(no)


@pytest.mark.parametrize("text,expected", [("a", False), ("*", True), (r"\*", False), (r"\\*", True), (r"\\\*", False), ("a?", True), (r"a\?b*", True), ("", False), ("\\", False)])
def test_unescaped_wildcard(text, expected):
    assert has_wildcard(text) is expected


def test_modifiers_types_and_paths(spark):
    events = [{"a": {"b": 4624}, "l": ["X", True, None], "g": 1e10}, {"a.b": 4624, "g": False}, {"a": {"b": 1}, "a.b": 4624}, {"a": {}}]
    assert hits(spark, "s: {a.b: 4624}\ncondition: s", events) == [True, True, False, False]
    assert hits(spark, "s: {l: \"['x', true, none]\"}\ncondition: s", events) == [True, False, False, False]
    assert hits(spark, "s: {g: ['10000000000.0', false]}\ncondition: s", events) == [True, True, False, False]
    assert hits(spark, "s: {l|contains|all: [x, none]}\ncondition: s", events) == [True, False, False, False]
    assert hits(spark, "s: {a.b|startswith: 46}\ncondition: s", events)[:2] == [True, True]
    assert hits(spark, "s: {a.b|contains: []}\ncondition: s", events) == [True] * 4
    assert hits(spark, "s: {}\ncondition: s", events) == [False] * 4
    assert flatten({"a": {"b": 1}, "a.b": 2, "c": {}, "d": None}) == {"a.b": "1", "d": ""}


def test_mapping(spark):
    events = [{"EventID": 1234}, {"winlog.event_id": 1234}, {"EventID": 1234, "winlog.event_id": 5678}, {"EventID": 1}]
    assert hits(spark, "s: {EventID: 1234}\ncondition: s", events, {"EventID": ["winlog.event_id"]}) == [True, True, True, False]
    both = [{"f": None, "g": None}, {"f": "x"}, {"g": "x"}, {}]
    assert hits(spark, "s: {f: null}\ncondition: s", both, {"f": ["f", "g"]}) == [True, False, False, True]
    assert hits(spark, "s: {f: [null, y]}\ncondition: s", both, {"f": ["f", "g"]}) == [True, True, True, True]
    assert FieldMapping({"a": ["b", "a"]})("a") == ["b", "a"] and FieldMapping({"a": ["b"]})("a") == ["b", "a"] and FieldMapping()("a") == ["a"]


@pytest.mark.parametrize("text,names", [("a: b\nc: [d, '', e]\nn:\nz: []", {"a": ["b"], "c": ["d", "e"]}), ("a: 1\nb: c", {}), ("- a", {}), ("", {}), (None, {}), ("a: [1]", {}), ("a: {", {}), ("a: ''", {})])
def test_mapping_text(text, names):
    assert load_mapping(text).names == names


def test_keywords_and_filters(spark):
    events = [{"api_token": "x", "path": "C:\\Windows"}, {"m": "Failed LOGON"}, {"m": "ok"}, "[1]", "{bad", {"m": "logon", "drop": 1}]
    assert hits(spark, "k: [api_token, logon]\ncondition: k", events, filters=["s: {drop: 1}\ncondition: s"]) == [True, True, False, None, None, False]
    assert hits(spark, "k: ['C:\\Windows']\ncondition: k", events)[0] is False


def test_quantifiers(spark):
    events = [{"a": 1}, {"b": 1}, {"a": 1, "b": 1}]
    base = "selection: {a: 1}\nselectionfoo: {b: 1}\n_x: {b: 1}\n"
    assert hits(spark, base + "condition: 1 of selection_*", events) == [True, True, True]
    assert hits(spark, base + "condition: ALL OF selection*", events) == [False, False, True]
    assert hits(spark, base + "condition: all of them", events) == [False, False, True]
    assert hits(spark, base + "condition: 1 of _x*", events) == [False, True, True]


@pytest.mark.parametrize("detection", [
    "s: {a|re: x}\ncondition: s", "s: {a|startswith: 'x*'}\ncondition: s", "s: {a|contains: ''}\ncondition: s", "s: {a: {b: c}}\ncondition: s", "s: []\ncondition: s", "s: [a, {b: c}]\ncondition: s",
    "s: x\ncondition: s", "s: {a: b}\ncondition: t", "s: {a: b}\ncondition: not not s", "s: {a: b}\ncondition: (s", "s: {a: b}\ncondition: s)", "s: {a: b}\ncondition: s and", "s: {a: b}\ncondition: s | count() > 1",
    "s: {a: b}\ncondition: all of s", "s: {a: b}\ncondition: 1 of *s", "s: {a: b}\ncondition: 1 of tt*", "s: {a: b}", "s: {a: b}\ncondition: [s]", "s: {a: b}\nt: 5m\ncondition: 1 of them", "s: {a|endswith: []}\ncondition: s",
])
def test_unsupported(detection):
    with pytest.raises(RuleNotSupported):
        rule(detection)


@pytest.mark.parametrize("text", ["", "a: [", "title: x", "detection: []", "- a"])
def test_no_detection(text):
    with pytest.raises(RuleNotSupported):
        parse_rule(text, "r")


def test_loading():
    text = "title: T\nlevel: low\ndetection:\n  s: {a: b}\n  condition: s"
    ok = {"case": {"id": "b"}, "sigma": {"text": text}, "tags": {"technique": [{"id": "T1"}, {"name": "n"}]}, "extra": 1}
    named = {"case": {"id": "a", "name": "N"}, "sigma": {"text": text, "level": "high"}, "tags": {"technique": "bad"}}
    rules, errors = load_rules([ok, named, {"case": {"id": "c"}, "sigma": {"text": "x: ["}}, {"case": {}}, None, {"case": {"id": 1}, "sigma": {"text": text}}])
    assert [(r.rule_id, r.title, r.level, r.technique_ids) for r in rules] == [("a", "N", "high", []), ("b", "T", "low", ["T1"])]
    assert rules[1].techniques == ({"id": "T1", "name": None}, {"id": None, "name": "n"}) and len(errors) == 4
    assert load_filters({"f": text, "g": "{"})[0][0].rule_id == "f"
    assert used_fields(rules, FieldMapping({"a": ["x"]})) == ["x", "a"]


def interpret(tree, flat, raw, mapping):
    if isinstance(tree, Not):
        return not interpret(tree.part, flat, raw, mapping)
    if isinstance(tree, (Every, Some)):
        parts = [interpret(p, flat, raw, mapping) for p in tree.parts]
        return bool(parts) and (all(parts) if isinstance(tree, Every) else any(parts))
    assert isinstance(tree, Atom)

    def one(x, v):
        v = v.lower()
        if tree.command == "wildcard":
            return re.search(wildcard_pattern(v).replace("(?d)", "").replace(r"\z", r"\Z"), x) is not None
        return {"equals": x == v, "contains": v in x, "startswith": x.startswith(v), "endswith": x.endswith(v)}[tree.command]

    tests = [(all if tree.every else any)(one(raw if n == RAW_EVENT else flat.get(n, ""), v) for v in tree.values) for n in mapping(tree.name)]
    return all(tests) if tree.values == ("",) else any(tests)


def test_random_rules(spark):
    rng = random.Random(5)
    values = ["ab", "a*", "?b", "", "B\\c", "it's", 'q"q', "x y", "é", "AB", "1"]
    mapping = FieldMapping({"f": ["g"], "h": ["h", "f"]})

    def atom():
        command = rng.choice(["", "", "|contains", "|startswith", "|endswith|all"])
        own = [v for v in values if v and "*" not in v and "?" not in v] if command else values
        return f"{rng.choice('fgh')}{command}: {dumps(rng.sample(own, rng.randint(1, 2)))}"

    rules = []
    for i in range(40):
        text = "\n".join(f"  s{k}: {{{atom()}}}" for k in range(3))
        condition = rng.choice(["s0 and not s1 or s2", "1 of s*", "all of s*", "not (s0 or s1) and s2", "s0 or s1 and s2", "not s0"])
        rules.append(parse_rule(f"detection:\n{text}\n  k: [ab, c]\n  condition: {condition} or (k and s0)", f"r{i:02}"))
    events = [{k: rng.choice([*values, None, 1, True, "ab\n", "xaby"]) for k in rng.sample("fgh", rng.randint(0, 3))} for _ in range(120)]
    df = spark.createDataFrame([(i, dumps(e)) for i, e in enumerate(events)], "i int, value string")
    for r in tag_events(df, rules, mapping=mapping).collect():
        e = events[r.i]
        assert r.sigma_rule_ids == [x.rule_id for x in rules if interpret(x.tree, flatten(e), dumps(e).lower(), mapping)], e
