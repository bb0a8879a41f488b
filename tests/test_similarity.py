import random

import numpy as np
import pytest

import parcelmill as pm
from parcelmill.functions import pairs, similarity
from parcelmill.functions.dictionaries import COST_CATEGORIES, SERVICES
from parcelmill.operators import matching
from parcelmill.operators.matching import dict_match


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 100.0 * (1.0 - (len(a) + len(b) - 2 * lcs(a, b)) / (len(a) + len(b)))


def partial_ratio(a, b):
    if not a or not b:
        return 0.0
    best = 0.0
    for needle, text in ((a, b), (b, a)):
        if len(needle) <= len(text):
            m, n = len(needle), len(text)
            windows = [text[max(0, i) : min(n, i + m)] for i in range(1 - m, n)]
            best = max([best] + [ratio(needle, w) for w in windows])
    return best


def random_texts(count, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcüs e") for _ in range(rng.randint(0, longest))) for _ in range(count)]


@pytest.mark.parametrize("key", ["abc", "s", "ebbe sü", "transport", "dritte partei transport"])
def test_scores_equal_plain_dynamic_programming(key):
    texts = random_texts(150, 30, len(key)) + ["", key, key[:-1], "x" + key, key.upper()]
    assert list(similarity.scores(texts, key, "ratio")) == [ratio(t, key) for t in texts]
    assert list(similarity.scores(texts, key, "partial")) == [partial_ratio(t, key) for t in texts]


def test_rounds_do_not_change_scores(monkeypatch):
    texts = random_texts(60, 20, 5)
    whole = list(similarity.scores(texts, "abc e", "partial"))
    monkeypatch.setattr(similarity, "_CHARS_PER_ROUND", 10)
    assert list(similarity.scores(texts, "abc e", "partial")) == whole


def plain_match(text, dictionary, score, threshold, mode):
    best, answer = 0, None
    for key, value in dictionary.items():
        points = {"ratio": ratio, "partial": partial_ratio}[score](key.lower(), text)
        if mode == "first" and points > threshold:
            return value
        if mode == "best" and points > best:
            best, answer = points, value
    return answer if mode == "best" and best >= threshold else None


@pytest.mark.parametrize(
    "dictionary, score, threshold, mode",
    [
        (COST_CATEGORIES, "partial", 70.0, "best"),
        ({name: name for name in SERVICES}, "ratio", 70.0, "best"),
        ({name: name for name in SERVICES}, "partial", 85.0, "first"),
    ],
)
def test_dict_match_equals_plain_loop(spark, dictionary, score, threshold, mode):
    rng = random.Random(3)
    texts = [None, "", "a", "t", "ex"]
    for key in list(dictionary) * 4:
        chars = list(key.lower())
        for _ in range(rng.randint(0, 3)):
            chars[rng.randrange(len(chars))] = rng.choice("aeiou tz")
        texts.append(rng.choice(["", "12 ", "doc "]) + "".join(chars) + rng.choice(["", " 1", " extra words"]))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = dict_match(df, "t", dictionary, score, threshold, mode).collect()
    for row in rows:
        expected = None if row.t is None else plain_match(row.t, dictionary, score, threshold, mode)
        assert row.match == expected, row.t


# --- many pairs at once, dictionaries of any size ---


def _words(draw, count, low, high, letters):
    return ["".join(draw.choice(letters) for _ in range(draw.randint(low, high))) for _ in range(count)]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "aé日🙂x"])
@pytest.mark.parametrize("low, high, count", [(0, 9, 14), (1, 14, 10), (63, 70, 3), (125, 131, 2)])
def test_pairs_equal_plain_scores(letters, low, high, count):
    draw = random.Random(low)
    texts, keys = _words(draw, count, low, high, letters), _words(draw, count, max(1, low), high, letters)
    keys += [t[: len(t) // 2] + "x" + t[len(t) // 2 + 1 :] for t in texts[:3]] + texts[:1]
    keys = [key for key in keys if key]
    sides = pairs.Strings.pair(texts, keys)
    t, k = (x.ravel() for x in np.meshgrid(range(len(texts)), range(len(keys)), indexing="ij"))
    plain = {"ratio": [ratio(texts[i], keys[j]) for i, j in zip(t, k)], "partial": [partial_ratio(texts[i], keys[j]) for i, j in zip(t, k)]}
    assert np.allclose(pairs.ratios(*sides, t, k), plain["ratio"], atol=1e-9)
    assert np.allclose(pairs.partial_ratios(*sides, t, k), plain["partial"], atol=1e-9)
    for score, threshold in ((s, x) for s in plain for x in (35.0, 70.0, 85.0, 100.0)):
        near = {}
        for i, j, value in pairs.near_pairs(texts, keys, score, threshold):
            near |= {(x, y): z for x, y, z in zip(i.tolist(), j.tolist(), value.tolist()) if z >= threshold}
        want = {(x, y): z for x, y, z in zip(t.tolist(), k.tolist(), plain[score]) if z >= threshold - 1e-9}
        assert near.keys() == want.keys() and all(abs(near[p] - want[p]) < 1e-9 for p in near)


@pytest.mark.parametrize("score, threshold, mode", [("ratio", 70.0, "best"), ("ratio", 60.0, "first"), ("partial", 75.0, "best"), ("partial", 85.0, "first")])
def test_a_table_matches_as_a_mapping_does(spark, score, threshold, mode, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK", 40)
    draw = random.Random(6)
    keys = list(dict.fromkeys(w for w in _words(draw, 300, 1, 24, "abcdeé ") if w))
    places = list(range(len(keys)))
    draw.shuffle(places)
    entries = sorted(zip(places, keys))
    texts = _words(draw, 250, 0, 30, "abcdeé ") + [k[:3] + "x" + k[4:] for k in keys[:120]] + ["ABC de", None, "", keys[5]] * 30
    dictionary = {key: f"v{place}" for place, key in entries}
    rows = spark.createDataFrame([(t, "x", "y", 1) for t in texts], "text string, value string, key string, ord int")
    table = spark.createDataFrame(
        [(key, f"v{place}", place) for place, key in entries] + [(entries[3][1].upper(), "late", 9999), (None, "no key", 1), ("", "empty", 2), ("abc", "no place", None)],
        "key string, value string, ord int",
    )
    got = pm.dict_match(rows, "text", table, score, threshold, mode)
    want = pm.dict_match(rows, "text", dictionary, score, threshold, mode)
    assert got.columns == want.columns
    rows_of = lambda df: sorted(map(repr, map(tuple, df.collect())))
    assert rows_of(got) == rows_of(want)
    assert sum(r.match is not None for r in got.collect()) > 100


def test_a_dictionary_of_100_000_entries(spark):
    entries = spark.range(100_000).selectExpr("concat(left(md5(cast(id as string)), 12), ' ', id) as key", "concat('v', id) as value", "id as ord")
    rows = spark.range(0, 100_000, 997).selectExpr("id", "concat(left(md5(cast(id as string)), 5), substr(md5(cast(id as string)), 7, 6), '  ', id) as text")
    got = pm.dict_match(rows, "text", entries, "ratio", 85.0, "best")
    assert all(r.match == f"v{r.id}" for r in got.collect())


def _edited(draw, text, edits, letters):
    for _ in range(edits):
        at = draw.randrange(len(text))
        text = text[:at] + draw.choice(["", draw.choice(letters) + text[at], draw.choice(letters)]) + text[at + 1 :]
    return text


@pytest.mark.parametrize("letters, hot", [("ab", 1024), ("abcdef é🙂", 1024), ("abc", 3)])
def test_texts_that_segments_settle_match_as_in_blocks(spark, monkeypatch, letters, hot):
    monkeypatch.setattr(matching, "HOT", hot)
    draw = random.Random(len(letters))
    keys = list(dict.fromkeys(draw.choice(["", "one same beginning "]) + w for w in _words(draw, 400, 8, 30, letters)))
    keys += [_edited(draw, k, 2, letters) for k in keys[:150]]
    texts = {_edited(draw, draw.choice(keys), n % 5, letters) for n in range(600)} | set(_words(draw, 50, 1, 30, letters))
    texts = spark.createDataFrame([(t,) for t in texts if t], "text string")
    entries = spark.createDataFrame([(k, f"v{i}", i) for i, k in enumerate(dict.fromkeys(k for k in keys if k))], "key string, value string, ord long")
    got = matching.table_matches(texts, entries, "ratio", 80.0, "best")
    want = matching._block_matches(texts, entries, "ratio", 80.0, "best")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_every_key_two_characters_away_is_found():
    draw = random.Random(2)
    probes = matching._probes()
    for _ in range(3000):
        key = "".join(draw.choice("abcd") for _ in range(draw.randint(10, 25)))
        text = key
        for _ in range(draw.randint(0, 2)):  # one character more or less
            at = draw.randint(0, len(text))
            text = text[:at] + draw.choice(["abcd"[draw.randrange(4)] + text[at:], text[at + 1 :]])
        cut = sorted([0, len(key), *draw.sample(range(1, len(key)), 3)])
        part = lambda s, i, at: s[cut[i] + at : cut[i + 1] + at]
        assert any(
            len(text) + delta == len(key) and part(text, i, at_i) == part(key, i, 0) and part(text, j, at_j) == part(key, j, 0)
            for delta, i, j, at_i, at_j in probes
        )
    for m, cut in matching._cuts(["x" * m for m in range(10, 40)] + ["abc def 123456", "abd def 654321"] * 9):
        assert len(cut) == 5 and cut[0] == 0 and cut[-1] == m and all(a < b for a, b in zip(cut, cut[1:]))


def test_texts_near_a_key_do_not_meet_all_keys_of_their_length(spark, monkeypatch):
    in_blocks, blocks = [], matching._block_matches
    monkeypatch.setattr(matching, "_block_matches", lambda texts, *rest: in_blocks.append(sorted(r.text for r in texts.collect())) or blocks(texts, *rest))
    entries = spark.range(3000).selectExpr("concat('large ring ', left(md5(cast(id as string)), 10)) as key", "concat('v', id) as value", "id as ord")
    spelt = "case id % 3 when 0 then concat('l', substr(key, 3)) when 1 then concat(left(key, 17), 'z', right(key, 3)) else key end"
    rows = entries.selectExpr("ord as id", "key").selectExpr("id", f"{spelt} as text")
    rows = rows.unionByName(spark.createDataFrame([(-1, "large ring, none of them"), (-2, "part 7"), (-3, None)], "id long, text string"))
    got = {r.id: r.match for r in pm.dict_match(rows, "text", entries, "ratio", 85.0, "best").collect()}
    assert got == {i: f"v{i}" for i in range(3000)} | {-1: None, -2: None, -3: None}
    assert in_blocks == [["large ring, none of them", "part 7"]]


def test_empty_tables_match_nothing(spark):
    rows, table = spark.createDataFrame([("a",), (None,)], "text string"), spark.createDataFrame([], "key string, value string, ord int")
    assert [r.match for r in pm.dict_match(rows, "text", table).collect()] == [None, None]
    full = spark.createDataFrame([("a", "v", 1)], "key string, value string, ord int")
    assert pm.dict_match(rows.limit(0), "text", full).count() == 0
    assert {r.text: r.match for r in pm.dict_match(rows, "text", full).collect()} == {"a": "v", None: None}
