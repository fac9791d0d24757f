import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.helpers import clashing, rows
from voxloom.llm import confusables as c


def test_forms():
    same = ["See the first café, 12 o'clock", "Ｓｅｅ the ﬁrst café,　１２ o'clock", "See the first café,​ 12 o'clock",
            "Ѕee the first caf­é, 12 o'clock", "See the ﬁrst сafé, 12 o'cl⁠ock", "﻿See the fi‍rst cafe​́, 12 o'clock"]
    assert len({c.canonical(t) for t in same}) == 1 and c.canonical(same[1]) == "See the first café, 12 o'clock"
    other = ["See the first cafe, 12 o'clock", "see the first café, 12 o'clock", "See the first café, 13 o'clock", "See the first café, 12  o'clock", "See the first cafè, 12 o'clock"]
    assert len({c.canonical(t) for t in [same[0], *other]}) == 6
    assert c.canonical("a\r\nb\rc d") == "a\nb\nc\nd" and c.canonical("x‑y‐z") == "x-y-z"
    assert c.canonical("ё") == "ë" == c.canonical("ё") and c.canonical("ḍ̇") == c.canonical("ḍ̇") and c.canonical("Йод") == "Йoд"
    assert c.canonical(None) is None and c.canonical("") == "" and c.canonical("plain") == "plain"


def test_table_is_consistent():
    one = c.singles()
    assert all(c.canonical(to) == to for to in one.values()) and one["　"] == " " and one["ﬃ"] == "ffi" and one["，"] == ","


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=30))
def test_idempotent_and_ignores_normal_forms(t):
    x = c.canonical(t)
    assert c.canonical(x) == x
    assert c.canonical(unicodedata.normalize("NFD", t)) == c.canonical(unicodedata.normalize("NFC", t))


def test_pairs(spark):
    data = [(1, "a b"), (2, "a b"), (3, "a b"), (4, "ａ b"), (5, "a c"), (6, None), (7, None), (8, ""), (9, "​"), (10, "a b"), (11, "x" * 300_000), (12, "x" * 299_999 + "ｘ"), (None, "a b")]
    df = spark.createDataFrame(data + data[:3], "doc_id long, text string")
    ids = [(i, t) for i, t in data if i is not None and t is not None]
    want = sorted([(a, b) for a, x in ids for b, y in ids if a < b and x != y and c.canonical(x) == c.canonical(y)], key=repr)
    assert rows(c.look_alike_pairs(clashing(df))) == want
    assert {r.doc_id: (r.class_id, r.texts) for r in c.look_alike_classes(df).collect()}[10] == (1, 3)
    assert {r.doc_id: r.changed for r in c.canonical_texts(df).collect()}[4] is True
    e = df.limit(0)
    assert c.look_alike_pairs(e).count() == 0 and c.look_alike_classes(e).count() == 0


def test_what_shows_stays():
    assert c.canonical("\u0600" + "12") == "\u0600" + "12" and c.canonical("\U0001F469\u200d\U0001F467") == "\U0001F469\u200d\U0001F467" != c.canonical("\U0001F469\U0001F467")
    assert c.canonical("\U0001F469\u200d") == "\U0001F469" and c.canonical("a\u200db\u200cc") == "abc" and c.canonical("\u0645\u06cc\u200c\u062e") == "\u0645\u06cc\u200c\u062e"


def test_cleaned_keeps_scripts():
    bg = "Съборът на реката беше в София, сок и хор."
    assert c.cleaned(bg) == bg and c.canonical(bg) != bg
    assert c.cleaned(bg.replace("р", "p").replace("о", "o")).split()[:3] == bg.split()[:3]
    assert c.cleaned("the gаrden сaу") == "the garden cay"
    assert c.cleaned("ｆｕｌｌ caf\u00ade\u0301") == "full café" and c.cleaned(None) is None


def test_canonical_order_and_longest_match():
    assert c.canonical("e\u0302\u0323") == c.canonical("e\u0323\u0302") == "\u1ec7" and c.canonical("\u1112\u1161\u11ab") == "\ud55c"
    assert c.canonical("\u0435\u0308") == "ë" and c.canonical("q\u0301\u0301") == "q\u0301\u0301"
