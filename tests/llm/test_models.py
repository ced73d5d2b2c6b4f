"""Trained operators: exactness of their parts, held-out accuracy, awkward rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, frame, words

from rillstone.llm import ann, exchange, html_blocks, html_extract, html_training, licenses, maxent, ordinal, toxicity


# Ordinal regression


def test_four_grades_are_learned_in_order(spark):
    r = random.Random(1)
    marks = ["bad", "poor", "fair", "good"]
    rows = [(k, " ".join([marks[k % 4]] * 4 + [f"w{r.randint(0, 300)}" for _ in range(12)])) for k in range(400)]
    docs = frame(spark, rows)
    ratings = spark.createDataFrame([(k, k % 4) for k in range(300)] + [(None, 2), (0, None)], "doc_id long, grade int")
    model = ordinal.train(docs, ratings, "grade")
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    found = {x.row.doc_id: x for x in ordinal.graded(docs, model).collect()}
    right = [round(found[k].expected_grade) == k % 4 for k in range(300, 400)]
    assert np.mean(right) > 0.9


def test_quality_of_awkward_rows(spark):
    docs = frame(spark, documents())
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = ordinal.train(docs, none, "quality")
    found = ordinal.graded(docs, model).collect()
    assert len(found) == len(documents()) and all(x.expected_grade == 0 and x.accepted for x in found)
    assert ordinal.graded(frame(spark, []), model).count() == 0
    assert set(found[0].row.asDict()) == set(docs.columns)


def test_quality_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = ordinal.train(docs, labels.where("doc_id % 3 <> 0"), "quality")
    found = ordinal.graded(docs, model).select("row.doc_id", "accepted").join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    assert np.mean([x.accepted == bool(x.quality) for x in found]) > 0.9


# Toxicity


def test_block_max_finds_the_exact_neighbours():
    r = np.random.default_rng(3)
    rows = [np.unique(r.integers(0, 60, r.integers(1, 8))) for _ in range(700)]
    weights = [np.round(r.random(len(x)), 1) + 0.1 for x in rows]
    first = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    index = toxicity.BlockMax(toxicity.Vectors(first, np.concatenate(rows), np.concatenate(weights)), 60)
    dense = np.zeros((700, 60))
    for k, (t, w) in enumerate(zip(rows, weights, strict=True)):
        dense[k, t] = w
    for k in range(0, 700, 13):
        near, cosine = index.nearest(rows[k], weights[k], 15)
        scores = np.round(dense @ dense[k], 9)
        assert near.tolist() == np.lexsort((np.arange(700), -scores))[:15].tolist()
        assert np.allclose(cosine, scores[near])


def test_toxicity_learns_and_takes_awkward_rows(spark):
    r = random.Random(8)
    rows = [(k, " ".join([f"w{r.randint(0, 400)}" for _ in range(40)] + ["vilely" if k % 8 == 0 else "ok", "vilest" if k % 8 == 0 else "fine"])) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0 and k % 8 == 0)) for k in range(0, 300)] + [(None, 1), (1, None)], "doc_id long, toxic int")
    docs = frame(spark, rows + documents())
    model = toxicity.train(docs, labels)
    found = {x.row.doc_id: x for x in toxicity.scored(docs, model).collect()}
    assert all((found[k].score >= 0.3) == (k % 8 == 0) for k in range(310, 400))
    assert 0 <= found[401].score <= 1 and len(found[320].evidence) == 3
    single = toxicity.train(docs, labels.where("toxic = 0"))
    assert {x.score for x in toxicity.scored(docs, single).collect()} == {0.0}
    assert toxicity.scored(frame(spark, []), model).count() == 0


@pytest.mark.parametrize("per_label", [40, 2000])
def test_toxic_terms_do_not_depend_on_the_balance_of_examples(spark, per_label):
    r = random.Random(4)
    mark = lambda share: "halfbad" if r.random() < share else "ok"
    rows = [(k, f"w{r.randint(0, 400)} " * 9 + mark(1.0 if k % 10 == 0 else 0.15)) for k in range(400)]
    rows += [(1000 + k, "halfbad") for k in range(100)]  # without labels
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(400)], "doc_id long, toxic int")
    model = toxicity.train(frame(spark, rows), labels, per_label=per_label)
    ((_, _, h, _, _),) = toxicity._term_rows(pa.array(["halfbad"]))
    at = np.searchsorted(model.vocabulary, np.sort(h))
    assert np.array_equal(model.vocabulary[at], np.sort(h))
    held = sum("halfbad" in t for _, t in rows)
    assert np.allclose(model.idf[at], math.log(501 / (held + 1)) + 1)


# Language model


def test_counts_and_base_scores(spark):
    rows = documents()
    found = maxent.score_texts(frame(spark, rows)).collect()
    tokens = [words(t, lower=True) + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    learn = [i is not None and not h for (i, _), h in zip(rows, held, strict=True)]
    counts = Counter(x for t, use in zip(tokens, learn, strict=True) if use for x in t)
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for (i, _), t, h in zip(rows, tokens, held, strict=True):
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in t)
        expected[(i, h, len(t), sum(counts[x] > 0 for x in t), total, round(base, 4))] += 1
    assert Counter((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 4)) for x in found) == expected
    assert all(math.isfinite(x.score) and x.score <= 0 for x in found)


def test_probabilities_sum_to_one():
    r = np.random.default_rng(1)
    uni = maxent.Unigrams(100, 10, 5, np.zeros(0, np.uint64), np.zeros(0, np.int64), r.random(maxent.SYMBOLS) + 0.01)
    model = maxent.Model(uni)
    model.weights[:] = r.normal(size=len(model.weights))
    tokens = r.integers(0, maxent.SYMBOLS, 50)
    features = maxent.histories(tokens, np.zeros(50, np.int64))
    whole = np.zeros(50)
    for k in range(maxent.CLASSES):
        classes, members = maxent.probabilities(model, model.weights, features, np.full(50, k))
        whole += classes[:, k] * members.sum(1)
    assert np.allclose(whole, 1, atol=1e-4)


def many_words(counts):
    """Words of one class and their counts; all other classes have none."""
    runs = sorted(Counter(counts).items(), reverse=True)
    each = [(5, 1)] + [(0, 1)] * 8 + runs + [(0, 1)] * (maxent.CLASSES - 9)
    count, words = np.array(each).T
    klass = np.concatenate([np.arange(9), [9] * len(runs), np.arange(9, maxent.CLASSES)])
    first = np.concatenate([[0], np.cumsum(np.bincount(klass, weights=words))]).astype(np.int64)
    return maxent.Unigrams(sum(counts) + 5, len(counts) + 1, 5, np.cumsum(words) - words, count, np.zeros(maxent.SYMBOLS), first)


@pytest.mark.parametrize("counts", [[1] * 5000, [4000, 900] + [3] * 40 + [1] * 700, [1 << k for k in range(40)], list(range(1, 300)), [7] * 23, [7] * 24, [2]])
def test_every_word_has_its_own_way_down(counts):
    uni = many_words(counts)
    numbers = np.arange(uni.others(np.array([9]))[0], uni.first[10])
    paths = maxent.paths_of(uni, numbers)
    r = np.random.default_rng(2)
    chance = np.exp(paths.bias + r.normal(size=paths.bias.shape))
    for table, wanted in ((np.exp(paths.bias), (uni.count_of(numbers) + 0.1) / (uni.count_of(numbers) + 0.1).sum()), (chance / chance.sum(1, keepdims=True), None)):
        ways = [list(zip(paths.split[a:b], paths.branch[a:b], strict=True)) for a, b in zip(paths.first, paths.first[1:], strict=False)]
        own = np.array([math.prod(float(table[x]) for x in way) for way in ways])
        assert len(set(map(tuple, ways))) == len(numbers) and np.isclose(own.sum(), 1, atol=1e-4) and (own > 0).all()
        assert wanted is None or np.allclose(own, wanted, rtol=1e-3)
    assert len(set(paths.key.tolist())) == len(paths.key)


def test_words_are_numbered_by_count_over_all_ranges(spark, monkeypatch):
    monkeypatch.setattr(exchange, "grid_for", lambda docs: exchange.Grid(7, 5))
    r = random.Random(9)
    rows = [(k, " ".join(f"{r.choice(['w', 'W', 'é', '7'])}{r.randint(0, 1 << r.randint(1, 10))}" for _ in range(60))) for k in range(120)] + [(500, None), (None, "w1 only")]
    plain = spark.createDataFrame([(i, t, i is not None and i % 10 != 0, False) for i, t in rows], "id long, text string, learn boolean, held_out boolean")
    counts, blocked, block = maxent.word_counts(plain)
    uni = maxent.unigrams_of(counts, 108)
    texts = dict(rows)
    number = {}
    for row in maxent.numbered(blocked, block, counts, uni).collect():
        own = np.frombuffer(row.words, uni.kind).tolist()
        assert len(own) == len(words(texts[row.id], lower=True))
        for word, x in zip(words(texts[row.id], lower=True), own, strict=True):
            assert number.setdefault(word, x) == x
    seen = Counter(w for i, t in rows if i is not None and i % 10 != 0 for w in words(t, lower=True))
    assert len({number[w] for w in seen}) == len(seen) and uni.distinct == len(seen) + 1 and uni.tokens == sum(seen.values()) + 108
    assert uni.first[-1] == 1 + len(seen) + maxent.CLASSES - 1
    assert uni.count_of(np.array([number[w] for w in number])).tolist() == [seen[w] for w in number]


def test_rare_words_are_told_by_their_history(spark):
    """80 pairs of equally frequent words of one class, far more than are members on their own."""
    r = random.Random(6)
    pair = lambda k, j: f"a{k}x b{j}x"
    rows = [(k, " ".join(pair(j, j) for j in r.sample(range(80), 80))) for k in range(1, 300)]
    held = [i for i in range(1000, 9000) if zlib.crc32(str(i).encode()) % 10 == 0][:160]
    rows += [(held[2 * j + m], pair(j, (j + m) % 80)) for j in range(80) for m in (0, 1)]
    found = {x.doc_id: x for x in maxent.score_texts(frame(spark, rows)).collect()}
    right, wrong = ([found[i] for i in held[m::2]] for m in (0, 1))
    assert len({round(x.base_score, 6) for x in right + wrong}) == 1
    gains = [x.score - y.score for x, y in zip(right, wrong, strict=True)]
    assert np.median(gains) > 0.5 and np.mean(gains) > 0.5


def some_tokens(uni, n, most, seed=3):
    """``n`` tokens of three texts, of the ``most`` most frequent words of class 9."""
    r = np.random.default_rng(seed)
    number = (uni.first[9] + r.integers(0, most, n - 3)).astype(uni.kind)
    texts = pa.array([x.tobytes() for x in np.array_split(number, 3)], pa.binary())
    ((_, _, tokens),) = maxent.tokens_in(texts, uni)
    return tokens


def test_exponentials_are_taken_per_history_not_per_token(monkeypatch):
    uni = many_words(list(range(1, 300)))
    uni.mass[:] = 1
    tokens, model, taken = some_tokens(uni, maxent.STEP_TOKENS, 20), maxent.Model(uni), []
    plain = maxent._chances
    monkeypatch.setattr(maxent, "_chances", lambda weights, *rest: taken.append(weights.size) or plain(weights, *rest))
    maxent.update(model, model.weights.copy(), np.zeros_like(model.weights), tokens, 0, maxent.STEP_TOKENS)
    in_step, taken[:] = sum(taken), []
    maxent.log_probabilities(model, tokens)
    each = maxent.CLASSES + maxent.MEMBERS
    assert max(in_step, sum(taken)) < each * maxent.STEP_TOKENS / 2


def test_a_step_follows_the_slope_of_the_scores():
    """First squares of the slopes, and the directions taken, against differences of the scores that are returned."""
    uni = many_words([4000, 900] + [3] * 40 + [1] * 700)
    uni.mass[:] = np.random.default_rng(1).random(maxent.SYMBOLS) + 0.1
    tokens, model = some_tokens(uni, 600, 700), maxent.Model(uni)
    r = np.random.default_rng(4)
    model.weights[:] = r.normal(scale=0.3, size=len(model.weights))
    weights, squares = model.weights.copy(), np.zeros_like(model.weights)
    maxent.update(model, weights, squares, tokens, 0, 600)
    slope = np.sqrt(squares) * np.sign(model.weights - weights)
    assert np.allclose(weights, model.weights - maxent.RATE * slope / np.sqrt(squares + 1), atol=1e-5)
    start = np.cumsum([0, *model.sizes])
    for a, b in zip(start, start[1:], strict=False):
        some = a + np.concatenate([r.choice(np.flatnonzero(abs(slope[a:b]) > 0.3), 25), r.choice(np.flatnonzero(slope[a:b] == 0), 5)])
        for k in some:
            ends = []
            for step in (0.05, -0.05):
                model.weights[k] += step
                ends.append(-maxent.log_probabilities(model, tokens).sum() * math.log(10))
                model.weights[k] -= step
            assert math.isclose((ends[0] - ends[1]) / 0.1, slope[k], rel_tol=0.02, abs_tol=0.01)


def test_rows_are_added_by_place():
    r = np.random.default_rng(8)
    for at in (r.zipf(1.3, 20_000) % 3000, r.integers(5, 9, 300) << 20, np.full(70_000, 7), np.arange(500)[::-1], np.repeat(np.arange(80), np.arange(1, 81))):
        rows = r.normal(size=(len(at), 9)).astype(np.float32)
        place, sums = maxent._add_rows(at, rows)
        different, where = np.unique(at, return_inverse=True)
        wanted = np.zeros((len(different), 9))
        np.add.at(wanted, where, rows)
        order = np.argsort(place)
        assert (place[order] == different).all() and np.allclose(sums[order], wanted, atol=1e-2 if len(at) > 50_000 else 1e-3)


def test_training_helps_held_out_texts(spark, sf_dir):
    found = maxent.op10_maxent(spark, sf_dir).where("held_out").collect()
    assert sum(x.score for x in found) > sum(x.base_score for x in found)


def test_language_model_without_training_texts(spark):
    assert maxent.score_texts(frame(spark, [])).count() == 0
    (row,) = maxent.score_texts(frame(spark, [(None, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.held_out) == (3, 0, 0, False)


# Nearest neighbours


def exact(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for q, x in sorted({(i, tuple(v)) for i, v in good if i % every == 0}):
        scored = sorted((-float((np.array(x) * v).sum()), i) for i, v in {(i, tuple(v)): (i, v) for i, v in good}.values() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


def test_neighbours_of_few_vectors_are_exact(spark):
    r = np.random.default_rng(2)
    rows = [(k, [float(np.float32(x)) for x in r.normal(size=6)]) for k in range(45)]
    rows += [(100 + k, rows[0][1]) for k in range(30)] + [(200, None), (201, [0.0] * 6), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] * 6), (204, [float("inf")] * 6), (None, rows[1][1]), (205, [1.0])]
    rows += [rows[3]]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, list int, key int")
    found = [(x.query_id, x.rank, x.vec_id, x.score) for x in ann.nearest(table).collect()]
    wanted = exact([(i, v) for i, v in rows if v is None or len(v) == 6], 20, 20)
    assert [x[:3] for x in sorted(found)] == [x[:3] for x in wanted]
    assert np.allclose([x[3] for x in sorted(found)], [x[3] for x in wanted], atol=1e-12)
    assert ann.nearest(table.limit(0)).count() == 0


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_SIZE", 16)
    monkeypatch.setattr(ann, "PIECE", 40)
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 24))
    x = (centres[r.integers(0, 12, 1500)] + 0.7 * r.normal(size=(1500, 24))).astype(np.float32)
    x *= r.uniform(0.5, 1.5, (1500, 1)).astype(np.float32)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {(q, i) for q, _, i, _ in ann.nearest(table).collect()}
    want = {(q, i) for q, _, i, _ in exact([(k, v.tolist()) for k, v in enumerate(x)], 20, 20)}
    assert len(got & want) / len(want) >= 0.9


def test_recall_holds_as_lists_grow(spark, monkeypatch):
    """Vectors without clusters in more lists than any fixed number of opened ones would serve."""
    monkeypatch.setattr(ann, "LIST_SIZE", 10)
    x = np.random.default_rng(6).normal(size=(8000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {(r.query_id, r.vec_id) for r in ann.nearest(table, query_every=40).collect()}
    scores = x[::40].astype(float) @ x.T.astype(float)
    scores[np.arange(200), np.arange(0, 8000, 40)] = -9
    want = {(40 * q, i) for q, row in enumerate(np.argsort(-scores, 1)[:, :20].tolist()) for i in row}
    assert len(got & want) / len(want) >= 0.9


# Pages


@pytest.fixture(scope="module")
def field():
    return html_extract.train(html_training.labelled_pages(300))


def test_field_on_other_pages(field):
    wrong = total = 0
    for page, labels in html_training.labelled_pages(150, seed=77):
        found = [html_extract.LABELS[x] for x in field.labels(html_blocks.leaf_blocks(page))]
        wrong += sum(a != b for a, b in zip(found, labels, strict=True))
        total += len(labels)
    assert wrong / total < 0.03


def test_viterbi_is_the_best_of_all_sequences():
    r = np.random.default_rng(4)
    field = html_extract.Field(np.zeros((1, 2)), r.normal(size=(2, 2)))
    for n in range(1, 8):
        scores = r.normal(size=(n, 2))
        value = lambda s: sum(scores[t, s[t]] for t in range(n)) + sum(field.turns[s[t], s[t + 1]] for t in range(n - 1))  # noqa: B023,E731
        best = max((tuple((m >> t) & 1 for t in range(n)) for m in range(2**n)), key=value)
        assert tuple(field.viterbi(scores)) == best


@pytest.mark.parametrize("page,blocks", [
    ("<p>a<b>b</b> c<br>d</p>", ["ab c d"]), ("x &amp; &lt;y&gt;&#233;", ["x & <y>é"]), ("<p>1<p>2<li>3<li>4", ["1", "2", "3", "4"]),
    ("<script>var a='<p>no</p>'</script><style>p{}</style><p>yes", ["yes"]), ("<!-- <p>no</p> --><p>yes", ["yes"]), ("<p title='a>b'>t</p>", ["t"]),
    ("a < b and c > d", ["a < b and c > d"]), ("</div></p>x", ["x"]), ("", []), ("<p> \n&nbsp;</p>", []), ("<title>t</title><body>b", ["b"]), ("<a href=x>one</a> two", ["one two"]),
])
def test_leaf_blocks(page, blocks):
    assert [b.text for b in html_blocks.leaf_blocks(page)] == blocks


@pytest.mark.parametrize("page,blocks", [
    ("<html><head><title>T</title><body><p>a", ["a"]), ("<head><meta charset=x><title>T</title><p>a</p>", ["a"]), ("<head><title>T</title>a <b>b</b>", ["a b"]), ("<head> <style>x</style> </head><p>a", ["a"]),
    ("<div><svg><path d=x><p>a</p></div>", ["a"]), ("<svg><foreignObject><div>no</div></foreignObject><text>no</text></svg><p>a", ["a"]), ("<div><select><option>no<p>a</p></div>", ["a"]),
    ("<div><button>no<p>a</p></div>", ["a"]), ("<button><div>no</div></button><p>a", ["a"]), ("<div><canvas><p>a</p></div>", ["a"]), ("<canvas><p>no</p></canvas><p>a", ["a"]), ("<div><object data=x><p>a</p></div>", ["a"]),
    ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> holds</p><object><p>fallback</p></object><p>a</p></article>", ["so x=2 holds", "fallback", "a"]),
])
def test_silent_elements_without_an_end(page, blocks):
    assert [b.text for b in html_blocks.leaf_blocks(page)] == blocks


def test_pages_table(spark, field):
    rows = [(1, "u", "<nav>n m</nav><article><h1>T</h1><p>Body  of\nit.</p></article><footer>&copy; f</footer>"), (2, None, None), (None, "v", ""), (3, "w", "<" * 50_000)]
    table = spark.createDataFrame([(*x, "z") for x in rows], "page_id long, url string, html string, text string")
    found = {x.url: (x.page_id, x.text, x.n_chars) for x in html_extract.extract(table, field).collect()}
    assert found["u"] == (1, "T Body of it.", 13) and found[None] == (2, "", 0) and found["v"] == (None, "", 0) and "w" in found
    assert html_extract.extract(table.limit(0), field).count() == 0


def test_given_pages_whole(spark, sf_dir, field):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {x.page_id: x.text for x in html_extract.extract(pages, field).collect()}
    for row in pages.collect():
        body = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x).replace("<br>", " ")).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert found[row.page_id] == " ".join(x for x in parts if x)


# Licenses


def brute_licenses(text, threshold):
    lines = [(n, licenses.words_of(x)) for n, x in enumerate((text or "").split("\n"))]
    lines = [(n, w) for n, w in lines if w]
    out = []
    for number, (name, template) in enumerate(licenses.TEMPLATES):
        t = Counter(licenses.bigrams(licenses.words_of(template)))
        found = []
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                p = licenses.bigrams([w for _, own in lines[i : j + 1] for w in own])
                common = sum((Counter(p) & t).values())
                dice = 2 * common / (len(p) + sum(t.values()))
                if dice >= threshold:
                    found.append((-dice, j - i, i, j, common))
        taken = []
        for less, _, i, j, common in sorted(found):
            if all(j < x or i > y for x, y in taken):
                taken.append((i, j))
                out.append((name, number, lines[i][0], lines[j][0], common, round(-less, 9)))
    return sorted(out)


def test_license_scan(spark):
    r = random.Random(3)
    rows = [(i, t) for i, t in documents() if t is None or len(t) < 3000]
    for k, (_, template) in enumerate(licenses.TEMPLATES):
        own = template.split()
        for _ in range(r.randint(0, 3)):
            own[r.randrange(len(own))] = "other"
        cut = [" ".join(own[a : a + 9]) for a in range(0, len(own), 9)]
        rows.append((600 + k, "Some text before.\n\n" + "\n".join(cut) + "\nthe software is provided\n" + template.upper().replace("\n", " ")))
    found = licenses.scan_licenses(frame(spark, rows)).collect()
    got = sorted((x.doc_id, x.license, x.template, x.first_line, x.last_line, x.common, round(x.dice, 9)) for x in found)
    assert got == sorted((i, *m) for i, t in rows if i is not None for m in brute_licenses(t, licenses.THRESHOLD))
    assert licenses.scan_licenses(frame(spark, [])).count() == 0
