import random

from tests.helpers import clashing, rows
from voxloom.llm import truncation

SCHEMA = "gem_id long, route string, text string, start_s double, end_s double"
SUBJ, VERB, OBJ, TAIL = ["the map", "a patient gardener", "our first teacher", "the choir"], ["opens", "carries", "follows", "keeps"], ["the old gate", "a small book", "the long song", "every word"], [
    ", as the song says", ", and that is enough", " in plain words", " for many years"]


def sentence(rng):
    return f"{rng.choice(SUBJ).capitalize()} {rng.choice(VERB)} {rng.choice(OBJ)}{rng.choice(TAIL)}"


def corpus(seed=1, n=1500):
    rng = random.Random(seed)
    out, cut = [], set()
    for i in range(n):
        route = rng.choice(["chars", "bytes", "desk", "broken"])
        text = ". ".join(sentence(rng) for _ in range(rng.choice([1, 1, 2, 3, 6]))) + rng.choice([".", ".", "?", "", "!"])
        if rng.random() < 0.05:
            text = rng.choice(["Thank you so much", "All right", "um", "[MUSIC]", "The map carries…"])
        full = len(text)
        if route == "chars" and len(text) > 150:
            text = text[:147] + "..."
            cut.add(i)
        elif route == "bytes" and len(text.encode()) > 120:
            whole = text.encode()[:120].decode(errors="ignore")
            if not whole.rstrip().endswith((".", "?", "!")):
                cut.add(i)
            text = whole
        elif route == "broken" and len(text) > 60 and rng.random() < 0.15:
            k = rng.randint(40, len(text) - 5)
            if text[k - 1].isalpha() and text[k].isalpha():
                text = text[:k]
                cut.add(i)
        out.append((i, route, text, 0.0, max(0.3, full / 14)))
    return out, cut


def test_found(spark):
    data, cut = corpus()
    df = spark.createDataFrame(data + data[:50], SCHEMA)
    got = {r[0] for r in truncation.truncated(clashing(df)).filter("cut").select("id").collect()}
    assert len(got & cut) / len(cut) > 0.97 and len(got & cut) / len(got) > 0.97


def test_spikes(spark):
    data, _ = corpus(2)
    base = truncation._measured(spark.createDataFrame(data, SCHEMA), "gem_id", "route", "text", None, None)
    found = {(r.source, r.unit, r.len) for r in truncation.spikes(truncation.histograms(base)).collect()}
    assert ("chars", "chars", 150) in found and ("bytes", "bytes", 120) in found and not any(s in ("desk", "broken") for s, _, _ in found)


def test_report_and_edges(spark):
    data, cut = corpus(3, 400)
    data += [(9001, None, "x", None, None), (9002, "desk", None, None, None), (9003, "desk", "", None, None), (None, "desk", "lost id", None, None), (9004, "desk", "word " * 40_000 + "end.", 0.0, 1.0)]
    df = spark.createDataFrame(data, SCHEMA)
    rep = {r.route: r for r in truncation.by_source(truncation.truncated(df), df).collect()}
    assert rep["?"].records == 1 and rep["?"].cut == 0 and rep["desk"].cut == 0 and 0 < rep["chars"].share < 1 and rep["chars"].by_limit == rep["chars"].cut
    assert truncation.truncated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_endings():
    how = lambda t: truncation.ending(t)[0]
    assert [how(t) for t in ("a b.", "a b…", "a b —", "a b", "a b,", "[MUSIC]", "um", "a b\\u00", "a b�", "a b. [MUSIC]", "")] == ["end", "trail", "trail", "open", "comma", "none", "none", "broken", "broken", "end", "none"]
    assert rows is not None
