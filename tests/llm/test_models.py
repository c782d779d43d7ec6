"""Learned operators: exact parts against plain Python, the rest by held-out accuracy."""

import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tideline.llm import language, quality, queries, recurrent, rules, scoring, toxicity
from tideline.llm.common import fold, stored
from tideline.session import paths_made

DATA = "/root/testdata/sf0.01"


def remainder(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def labels_of(spark, column):
    rows = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", column).collect()
    return {r.doc_id: r[column] for r in rows}


# --- language model -----------------------------------------------------------------------------


def test_base_scores(make, odd, prose):
    texts, ids = odd
    texts, ids = [*texts, *[prose(i % 3, 200) for i in range(40)]], [*ids, *range(100, 140)]
    rows = scoring.scored(make(texts, ids), fold(F.col("doc_id"), 5) == 1, hot=60).collect()
    tokens = [(t or "").encode().lower().split() + [b""] for t in texts]
    count = Counter(w for i, ws in zip(ids, tokens, strict=True) if remainder(i, 5) != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    expected = sorted(
        (
            str(i), len(ws), sum(count[w] > 0 for w in ws), n,
            round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6),
        )
        for i, ws in zip(ids, tokens, strict=True)
    )
    got = sorted(
        (str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows
    )
    assert got == expected
    assert all(r.held_out == (remainder(r.doc_id, 5) == 1) and math.isfinite(r.score) for r in rows)


def test_model_is_better_than_its_base(spark):
    rows = queries.QUERIES["op1_lm_scoring"](spark, DATA).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 1000


def test_nothing_to_learn(make):
    held = F.lit(True)
    rows = scoring.scored(make(["a b", None]), held).collect()
    assert sorted((r.n_tokens, r.n_known, r.score) for r in rows) == [(1, 0, 0.0), (3, 0, 0.0)]
    assert scoring.scored(make([]), held).count() == 0


def network():
    draw = np.random.default_rng(1)
    group = draw.integers(0, 5, 90).astype(np.int32)
    word = np.where(group < 3, draw.integers(0, 4, 90), -1).astype(np.int32)
    symbol = draw.integers(0, 14, 90).astype(np.int32)
    texts = recurrent.Texts(symbol, group, word, np.array([0, 5, 6, 46, 90]))
    net = recurrent.Network.new(np.log(np.full(5, 0.2)), np.log(np.full((3, 4), 0.25)), 14)
    net = recurrent.Network({k: v.astype(np.float64) for k, v in net.weights.items()})
    for v in net.weights.values():
        v += draw.normal(0, 0.3, v.shape)
    return net, texts


def test_probabilities_sum_to_one():
    net, _ = network()
    states = np.random.default_rng(0).normal(size=(6, recurrent.HIDDEN))
    total = np.zeros(6)
    for group in range(5):
        for word in range(4) if group < 3 else [-1]:
            logs = net.token_logs(states, np.full(6, group), np.full(6, word))
            total += np.exp(logs)
    assert np.allclose(total, 1)


def test_windows_carry_the_state(monkeypatch):
    net, texts = network()
    whole = recurrent.score(net, texts)
    monkeypatch.setattr(recurrent, "WINDOW", 7)
    monkeypatch.setattr(recurrent, "LANES", 2)
    assert np.allclose(whole, recurrent.score(net, texts), atol=1e-5)
    h = np.zeros((1, recurrent.HIDDEN), np.float32)  # token by token
    for t in range(6, 46):
        logs = net.token_logs(h, texts.group[t : t + 1], texts.word[t : t + 1])
        assert np.isclose(logs[0], whole[t], atol=1e-5)
        h = net.step(h, texts.symbol[t : t + 1])[0]


def test_slopes_are_differences():
    net, texts = network()
    place = np.arange(40).reshape(10, 4)
    fresh = np.zeros((10, 4), bool)
    fresh[0] = fresh[6, 2] = True
    h = np.zeros((4, recurrent.HIDDEN))
    slopes, _, _, n = recurrent.slopes(net, h, place, fresh, texts)
    for name, slope in slopes.items():
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        value, losses = net.weights[name][at], []
        for move in (1e-3, -1e-3):
            net.weights[name][at] = value + move
            losses.append(recurrent.slopes(net, h, place, fresh, texts)[2])
        net.weights[name][at] = value
        assert np.isclose((losses[0] - losses[1]) / 2e-3 / n, slope[at], rtol=0.02, atol=1e-4), name


def test_tokens_are_words_and_an_end():
    odd = [None, "", " ", "a", " A  b\tB ", "x\x1cy\x85z\u00a0\u2003Ä\x0b", "\n\r\x0cq", "End end eND"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([*odd, *odd[::-1], None], pa.string())})
    for part in (batch, batch.slice(3, 7), batch.slice(1, 2), batch.slice(0, 0)):
        texts = part.column("text").to_pylist()
        expected = [[*(t or "").encode().lower().split(), b""] for t in texts]
        found, starts = scoring.tokens(part)
        assert found.to_pylist() == [w for ws in expected for w in ws]
        assert np.diff(starts).tolist() == [len(ws) for ws in expected]
        lex = scoring.Lexicon([b"", b"b"], np.array([5.0, 4.0]), 12, 5)
        places = lex.places(found)
        assert places.tolist() == [{b"": 0, b"b": 1}.get(w, 2) for ws in expected for w in ws]
        cold = scoring.cold_words(found, starts, np.flatnonzero(places == 2)).to_pylist()
        assert [{x["word"]: x["n"] for x in some} for some in cold] == [
            Counter(w for w in ws if w not in (b"", b"b")) for ws in expected
        ]
        counts = scoring.counted(part).to_pydict()
        assert dict(zip(counts["word"], counts["n"], strict=True)) == Counter(found.to_pylist())


def test_rows_that_rest_move_as_by_plain_adam():
    draw = np.random.default_rng(3)
    inputs, others = draw.normal(size=(9, 4)), draw.normal(size=5)
    plain, first, second = np.concatenate([inputs.ravel(), others]), np.zeros(41), np.zeros(41)
    adam = recurrent.Adam(inputs, others, 0.01)
    for step in range(1, 60):
        rows = np.flatnonzero(draw.random(9) < 0.2)
        of_rows, slopes = draw.normal(0, 0.7, (len(rows), 4)), draw.normal(0, 1e-5, 5)
        dense = np.zeros((9, 4))
        dense[rows] = of_rows
        g = np.clip(np.concatenate([dense.ravel(), slopes]), -1, 1)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        scale = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        plain -= scale * first / (np.sqrt(second) + 1e-6)
        adam.move(rows, of_rows, slopes)
    assert np.allclose(plain, np.concatenate([inputs.ravel(), others]), atol=1e-9)


def test_rows_of_a_symbol_are_added():
    draw = np.random.default_rng(4)
    symbol, d = np.minimum(draw.zipf(1.5, 300), 70_000), draw.normal(size=(300, 5))
    found, sums = recurrent.row_sums(symbol, d)
    assert found.tolist() == sorted(set(symbol.tolist()))
    assert np.allclose(sums, [d[symbol == s].sum(0) for s in found])


def test_steep_logits_stay_finite():
    x = np.array([[0, 500.0], [-700, -900], [3, 4]], np.float32)
    logs = recurrent.log_shares(x.copy(), np.array([0, 1, 0]))[0]
    assert np.allclose(logs, [-500, -200, -np.log1p(np.e)])


# --- language -----------------------------------------------------------------------------------


def test_language(spark):
    rows = queries.QUERIES["op5_language_id"](spark, DATA).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(make, odd, prose):
    texts, ids = odd
    teach = make([prose(1, 80), "über schöne Straßen", None], langs=["en", "de", None])
    model = language.learn(teach)
    assert model.languages == ["de", "en"]
    rows = language.predict(make(texts, ids), model, F.lit(False)).collect()
    assert len(rows) == len(texts)
    assert sorted(r.lang_pred for r in rows).count("und") == 3
    empty = language.learn(make([]))
    assert {r.lang_pred for r in language.predict(make(texts), empty, F.lit(False)).collect()} == {"und"}
    assert language.predict(make([]), model, F.lit(False)).count() == 0


def test_batches_do_not_matter(prose):
    texts = ["", "a", prose(1, 30), "ß", prose(2, 9)]
    model = language.Model(
        ["x", "y"], np.random.default_rng(0).normal(size=(1 << 15, 2)).astype(np.float32), np.zeros(2)
    )
    together = language.classify(texts, model)
    for i, t in enumerate(texts):
        one = language.classify([t], model)
        assert one[0][0] == together[0][i] and np.isclose(one[1][0], together[1][i])


def plain_grams(text):
    """Slots of the n-grams of a text, one at a time."""
    clean = f" {' '.join(''.join(c if c.isalpha() else ' ' for c in text.lower()).split())} "
    a, b, c, d = (int(x) for x in language.MULTIPLIERS)
    out = []
    for k in language.ORDERS:
        for i in range(len(clean) - k + 1):
            code = 0
            for x in clean[i : i + k]:
                code = (code * d + (ord(x) + 1) * a) % 2**32
            mixed = ((code ^ (code >> 15)) * b + (a, b, c)[k % 3]) % 2**32
            out.append(mixed >> (32 - language.BITS))
    return out


def test_language_against_plain_bayes(make, prose):
    texts = [*[prose(i % 7, 20 + i) for i in range(70)], "", "12 34", "a", None]
    langs = [*[f"l{i % 7}" for i in range(70)], "l0", "l1", "l2", "l3"]
    docs = make(texts, langs=langs)
    train = F.col("doc_id") % 3 != 1
    rows = language.predict(docs, language.learn(docs.where(train)), ~train).collect()
    counts, taught = {x: Counter() for x in sorted(set(langs))}, Counter()
    for i, (t, x) in enumerate(zip(texts, langs, strict=True)):
        if i % 3 != 1:
            counts[x].update(plain_grams(t or ""))
            taught[x] += 1
    for r in rows:
        text = texts[r.doc_id] or ""
        if not any(map(str.isalpha, text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        grams, sums = plain_grams(text), {}
        for x, table in counts.items():
            whole = sum(table.values()) + language.SMOOTHING * 2**language.BITS
            sums[x] = math.log((taught[x] + 1) / (sum(taught.values()) + len(counts)))
            sums[x] += sum(math.log((table[g] + language.SMOOTHING) / whole) for g in grams)
        best = max(sums.values())
        odds = sum(math.exp((v - best) / math.sqrt(len(grams))) for v in sums.values())
        assert sums[r.lang_pred] == pytest.approx(best, abs=0.02)
        assert r.score == pytest.approx(1 / odds, abs=0.01)


def test_blocks_of_languages(monkeypatch, make, prose):
    texts = [prose(i % 23, 30 + i) for i in range(92)]
    docs = make(texts, langs=[f"l{i % 23:02}" for i in range(92)])

    def found():
        rows = language.predict(docs, language.learn(docs), F.lit(True)).collect()
        return {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in rows}

    whole = found()
    assert all(v[0] == f"l{i % 23:02}" for i, v in whole.items())
    monkeypatch.setattr(language, "BLOCK", 4)
    monkeypatch.setattr(language, "CELLS", 64)
    assert found() == whole


def test_ties_go_to_the_first_language(monkeypatch, make, prose):
    docs = make([prose(1, 30)] * 6, langs=["c", "b", "a", "c", "b", "a"])
    for block in (2, 1):
        monkeypatch.setattr(language, "BLOCK", block)
        rows = language.predict(docs, language.learn(docs), F.lit(True)).collect()
        assert {(r.lang_pred, round(r.score, 9)) for r in rows} == {("a", round(1 / 3, 9))}


# --- quality ------------------------------------------------------------------------------------


def test_quality(spark):
    rows = queries.QUERIES["op6_quality_classifier"](spark, DATA).collect()
    truth = labels_of(spark, "quality")
    held = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    assert sum(r.predicted == truth[r.doc_id] for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_of_odd_rows(spark, make, odd, prose):
    texts, ids = odd
    labels = spark.createDataFrame(
        [(5, 1, 0), (8, 0, 1), (8, 0, 1), (9, None, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.scored(make(texts, ids), labels, F.lit(True)).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    none = quality.scored(make(texts, ids), labels.limit(0), F.lit(True)).collect()
    assert {r.score for r in none} == {0.0}
    assert quality.scored(make([]), labels, F.lit(True)).count() == 0


def test_pooling():
    shares = quality.pooled(np.array([0.1, 0.5, 0.3, 0.2, 0.9]), np.array([1.0, 1, 1, 2, 1]))
    assert np.allclose(shares, [0.1, 0.3, 0.3, 0.3, 0.9])


# --- toxicity -----------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_distances():
    terms = {"idiot": 3.0, "scum": 2.0, "trash": 1.0, "trashy": 4.0, "idiocy": 0.5}
    automaton = toxicity.Automaton(terms)
    words = {"", "s", "scum", "scm", "scums"}
    for term in terms:
        for i in range(len(term) + 1):
            words |= {term[:i] + c + term[i:] for c in "aesz"}
            words |= {term[:i] + term[i + 1 :], term[:i] + "q" + term[i + 1 :], term[:i] + "qq" + term[i:]}
    for word in words:
        near = [
            (distance(word, t), -w) for t, w in terms.items()
            if distance(word, t) == 0 or (distance(word, t) == 1 and len(t) >= toxicity.SHORTEST_FUZZY)
        ]
        best = min(near) if near else None
        assert automaton.match(word) == ((-best[1], best[0]) if best else None), word


def test_automaton_forgets_states(monkeypatch):
    """With room for few states the matches are the same and no more states are kept than a word makes."""
    terms = {f"{a}{b}{c}ly": 1.0 + i for i, a in enumerate("abcd") for b in "eio" for c in "rst"}
    words = [f"{a}{b}{c}{d}" for a in "abce" for b in "eiu" for c in "rst" for d in ("ly", "l", "y", "lly", "xx")]
    full = toxicity.Automaton(terms)
    wanted = [full.match(w) for w in words]
    monkeypatch.setattr(toxicity, "MAX_STATES", 4)
    small = toxicity.Automaton(terms)
    assert [small.match(w) for w in words] == wanted and any(wanted) and not all(wanted)
    assert len(small.states) <= 4 + 6 < len(full.states)


def test_every_term_that_passes_is_taken(spark):
    """More terms than the lexicon once held: all are there."""
    names = [f"zz{i:05d}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(25_000)]
    rows = [(" ".join(names), 1)] * 60 + [("nothing of that kind here", 0)] * 60
    found = toxicity.lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(names) <= set(found)


def test_quotation():
    automaton = toxicity.Automaton({"idiot": 3.0, "wormy*": 2.0})
    assert toxicity.features("you idiot", automaton)[:3] == (3.0, 0.0, 0.0)
    assert toxicity.features('the word "idiot" is rude', automaton)[:3] == (0.0, 3.0, 0.0)
    assert toxicity.features("they wrote idiot there", automaton)[:3] == (0.0, 3.0, 0.0)
    assert toxicity.features("you idi0t", automaton)[:3] == (0.0, 0.0, 3.0)
    assert toxicity.features("you wormylike thing", automaton)[:3] == (2.0, 0.0, 0.0)


def test_toxicity(spark):
    rows = queries.QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1").collect()
    truth = {
        r.doc_id: r.toxic
        for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    }
    held = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    caught = [r.predicted for r in held if truth[r.doc_id] == 1]
    clean = [r.predicted for r in held if truth[r.doc_id] == 0]
    assert sum(caught) > 0.85 * len(caught) and sum(clean) < 0.02 * len(clean)


def test_toxicity_of_odd_rows(spark, make, odd, prose):
    texts, ids = odd
    texts = [*texts, *[prose(i, 30) + (" you idiot scum" if i % 2 else "") for i in range(60)]]
    ids = [*ids, *range(100, 160)]
    marks = [(100 + i, 1, i % 2) for i in range(50)] + [(None, 1, 1), (100, None, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    df = make(texts, ids)
    rows = toxicity.scored(df, labels, F.lit(True), df.columns)
    assert rows.select("row.*").columns == df.columns and rows.count() == len(texts)
    scores = {r.row.doc_id: r.score for r in rows.collect()}
    assert all((scores[100 + i] >= 0.5) == (i % 2 == 1) for i in range(60))
    assert scores[1] < 0.5 and scores[None] < 0.5
    none = toxicity.scored(df, labels.limit(0), F.lit(True), ["doc_id"])
    assert {r.score for r in none.collect()} == {0.0}
    assert toxicity.scored(make([]), labels, F.lit(True), ["doc_id"]).count() == 0
    left = toxicity.kept(df, labels, F.col("doc_id") % 3 != 0, 0.5)
    same = toxicity.scored(df, labels, F.col("doc_id") % 3 != 0, df.columns)
    expected = same.where("score < 0.5").select("row.*")
    assert left.columns == df.columns and left.exceptAll(expected).isEmpty()
    assert expected.exceptAll(left).isEmpty() and 0 < left.count() < len(texts)
    assert toxicity.kept(df, labels.limit(0), F.lit(True), 0.5).count() == len(texts)
    assert toxicity.kept(make([]), labels, F.lit(True), 0.5).count() == 0


# --- the pipeline -------------------------------------------------------------------------------


def test_filters_store_no_texts(monkeypatch, spark, make, prose):
    schemas = []

    def noted(df, name="table"):
        schemas.append(df.schema.simpleString())
        return stored(df, name)

    monkeypatch.setattr(rules, "stored", noted)
    monkeypatch.setattr(toxicity, "stored", noted)
    df = make([prose(i, 40) for i in range(8)])
    for _, stage in corpus_pipeline.STAGES[:2]:
        stage(spark, df, DATA).collect()
    assert len(schemas) >= 3 and not any("text" in x for x in schemas)


def test_stages_handle_odd_rows(spark, make, odd):
    texts, ids = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (make(texts, ids), make([])):
            out = stage(spark, docs, DATA)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, make([]), DATA).count() == 0


@pytest.fixture(scope="module")
def kept(spark):
    before = paths_made()
    rows = corpus_pipeline.run(spark, DATA)
    assert paths_made() == before + 1  # what the stages stored on their way is gone
    return rows.collect()


def test_pipeline_keeps_clean_documents(spark, kept):
    ids = {r.doc_id for r in kept}
    quality_of, toxic = labels_of(spark, "quality"), labels_of(spark, "toxic")
    # some terms stand in too few of these texts to be learned
    bad = [i for i in toxic if toxic[i] == 1]
    assert len([i for i in bad if i in ids]) < 0.5 * len(bad)
    assert sum(quality_of.get(i) == 0 for i in ids) <= 2
    good = [i for i in quality_of if quality_of[i] == 1 and toxic[i] == 0]
    assert len([i for i in good if i in ids]) > 0.8 * len(good)


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert Path(corpus_pipeline.__file__).name == "corpus_pipeline.py"


def test_the_network_learns_from_every_training_document(make, prose, monkeypatch):
    """However much text there is: the shares of the rounds make up the whole."""
    training = make([prose(i, 6) for i in range(300)])
    learned_from = []

    def noted(some, lex, net):
        learned_from.extend(r.doc_id for r in some.select("doc_id").collect())
        return net

    monkeypatch.setattr(scoring, "trained", noted)
    for tokens in (10, 10**7, 10**12):
        learned_from.clear()
        scoring.learned(training, scoring.Lexicon([b"a"], np.ones(1), tokens, 1))
        assert set(learned_from) == set(range(300))
    assert len(learned_from) <= 303  # once each, but for the ends of the shares
