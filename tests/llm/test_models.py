"""Quality trees, secrets, the language model, extraction and the pipeline."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quillstone.llm import hmm_lm, html_crf, quality, secrets

from .conftest import AWKWARD
from .test_dedup import brute_exact, brute_near

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def brute_statistics(text):
    text = text or ""
    w, seen, lines = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    count = collections.Counter(grams)
    repeats = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), lines, len(repeats))


def test_op2_rows(rows, awkward, empty):
    none = rows("doc_id long, quality int")
    got = quality.judge_quality(awkward, none).collect()
    shown = lambda r: str(r[0]) + str(r[1:])
    want = []
    for i, t in AWKWARD:
        b = brute_statistics(t)
        want.append((i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
    assert sorted(map(shown, want)) == sorted(shown(tuple(r)[:7]) for r in got)
    assert all(r.kept != r.base_failed for r in got)  # without labels the base rules decide
    assert quality.judge_quality(empty, none).count() == 0
    assert quality.keep_good(awkward, none).columns == awkward.columns


def test_trees_are_monotone_and_right():
    rnd = np.random.default_rng(0)
    x = rnd.uniform(size=(600, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] < 0.5)).astype(float)
    trees = quality.fit_trees(x, y, monotone=(1, -1, 0))
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > 0.98
    grid = np.linspace(0, 1, 60)
    for j, sign in ((0, 1), (1, -1)):
        probe = np.repeat(rnd.uniform(size=(20, 1, 3)), 60, 1)
        probe[:, :, j] = grid
        assert (np.diff(trees.score(probe.reshape(-1, 3)).reshape(20, 60), axis=1) * sign >= -1e-12).all()


def test_op2_held_out(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in quality.judge_quality(docs, labels.where("doc_id % 2 = 0")).collect()}
    rest = [(r.quality, got[r.doc_id]) for r in labels.where("doc_id % 2 = 1").collect() if not got[r.doc_id].base_failed]
    assert np.mean([r.kept for q, r in rest if q]) > 0.98 and np.mean([r.kept for q, r in rest if not q]) < 0.1


ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


SECRETS = [
    "token = token: abcdefghijklmnop", "é Password:'abc.DEF-123=456'", "API_KEY==abcdefghijkl apikey : short", "AKIAABCDEFGHIJKLMN AKIAAKIAABC", "0123456789abcdef0", "secret=" + "0a" * 20,
    "secret = passwd = abcdefghijklmno", "", None, "key Zx9Zx9Zx9Zx9Zx9Zx9Zx9 end", "copied q1w2e3r4t5y6u7i8o9p0zz",
]


def test_op4(rows, awkward, empty):
    data = [(i, t, f"s{i % 3}") for i, t in enumerate(SECRETS * 2)] + [(99, "copied q1w2e3r4t5y6u7i8o9p0zz", s) for s in ("a", "b", "c", None)]
    got = {(r.doc_id, r.base_sha256): r for r in secrets.scan_secrets(rows("doc_id long, text string, source string", *data)).collect()}
    for i, t, _ in data:
        want = brute_spans(t or "")
        r = got[i, hashlib.sha256(want.encode()).hexdigest()]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(k + ":") for k in ("assign", "access", "hex"))
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    assert [r.spans for (i, _), r in got.items() if i == 9] == ["generic:4:25"]
    assert all(r.n_added == 0 and r.n_copied == 1 for (i, _), r in got.items() if i in (10, 99))
    assert secrets.scan_secrets(awkward).count() == len(AWKWARD) and secrets.scan_secrets(empty).count() == 0


def test_op4_positions_in_texts_of_many_matches(rows):
    """Matches in several blocks of blocks, of all kinds, next to each other and far apart."""
    rnd = random.Random(8)
    digits = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    forms = [lambda: digits(rnd.randint(14, 20)), lambda: f"token={digits(13)}", lambda: f"AKIA{digits(15).upper()}", lambda: "\u00e9t\u00e9", lambda: f"Zq{digits(20)}Q"]
    texts = [" ".join(rnd.choice(forms)() for _ in range(n)) for n in (1, 127, 128, 129, 700, 20_000)]
    got = {r.doc_id: r for r in secrets.scan_secrets(rows("doc_id long, text string, source string", *[(i, t, "s") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        want = brute_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        taken = [tuple(map(int, x.split(":")[1:])) for x in want.split(",") if x]
        added = [tuple(map(int, x.split(":")[1:])) for x in got[i].spans.split(",") if x.startswith("generic")]
        covered = np.zeros(len(t) + 1, bool)
        for a, b in taken:
            covered[a:b] = True
        free = [m.span() for m in re.finditer(r"(?<![A-Za-z0-9+_-])(?=[A-Za-z+_-]*[0-9])(?=[0-9+_-]*[A-Za-z])[A-Za-z0-9+_-]{20,}", t)]
        assert added == [(a, b) for a, b in free if not covered[a:b].any()]


def test_op4_masks_live_values_only(rows, awkward):
    live, copied = "token=abcdefghijkl1", "token=zyxwvutsrqponm"
    docs = rows("doc_id long, text string, source string, n_chars long, row_key string", (1, f"é {live} tail", "a", 26, "k"), *[(k, copied, s, 20, "k") for k, s in enumerate("abcd", 2)])
    got = {r.doc_id: r for r in secrets.mask_secrets(docs).collect()}
    assert got[1].text == "é token=[SECRET] tail" and got[1].n_chars == len(got[1].text) and got[2].text == copied and got[1].row_key == "k"
    assert secrets.mask_secrets(awkward).count() == len(AWKWARD)


def test_forward_is_exact():
    rnd = np.random.default_rng(1)
    k, c = 3, 4
    norm = lambda a, axis: a / a.sum(axis, keepdims=True)
    model = hmm_lm.Model(norm(rnd.random(k), 0), norm(rnd.random((k, k)), 1), norm(rnd.random((c, k)), 0), np.zeros(0), np.zeros(0), np.zeros(0))
    texts = [rnd.integers(0, c, n) for n in (1, 4, 3, 6)]
    sizes = np.array([len(t) for t in texts])
    got = hmm_lm.Sequences(np.concatenate(texts), sizes).log_likelihood(model)
    for text, score in zip(texts, got, strict=True):
        total = sum(model.start[s[0]] * model.emit[text[0], s[0]] * math.prod(model.move[a, b] * model.emit[o, b] for a, b, o in zip(s, s[1:], text[1:], strict=False)) for s in itertools.product(range(k), repeat=len(text)))
        assert math.isclose(score, math.log10(total), rel_tol=1e-9)
    sequences = hmm_lm.Sequences(np.concatenate(texts), sizes)
    for _ in range(5):  # each pass raises the likelihood
        before = sequences.log_likelihood(model).sum()
        start, move, emit = sequences.counts(model)
        assert math.isclose(start.sum(), 4) and math.isclose(emit.sum(), sizes.sum()) and math.isclose(move.sum(), sizes.sum() - 4)
        model = hmm_lm.Model(norm(start, 0), norm(move, 1), norm(emit, 0), model.top, model.mass, model.kinds)
        assert sequences.log_likelihood(model).sum() >= before - 1e-9


def check_op7(df, data):
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in data]
    count = collections.Counter(w for i, own in tokens if not hmm_lm.held_out(i) for w in own)
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(w), sum(count[x] > 0 for x in w), round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 3)) for i, w in tokens)
    got = hmm_lm.score_documents(df).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 3)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in got)
    return got


def test_op7_rows(rows, awkward, empty, corpus):
    check_op7(awkward, AWKWARD)
    check_op7(rows("doc_id long, text string", *corpus), corpus)
    assert hmm_lm.score_documents(empty).count() == 0


def test_op7_score_is_the_sum_over_all_paths(spark, rows):
    """Class by path, times the word's share of its class; and a class's words, with the unseen, share out 1."""
    data = [(i, " ".join(random.Random(i).choices(["a", "b", "to", "be", "or", "not", "Xy"], k=n))) for i, n in enumerate([0, 1, 2, 3, 4, 5, 5, 4, 6, 2, 3, 30, 40])] + [(99, "unseen b")]
    docs = rows("doc_id long, text string", *data)
    states, top_words = 2, 3
    got = {r.doc_id: r.score for r in hmm_lm.score_documents(docs, states, top_words).collect()}
    segments = hmm_lm.common.settle(hmm_lm._segments(docs), "test-segments")
    counted = hmm_lm.common.settle(hmm_lm._corpus_counts(segments, 3, top_words), "test-counts")
    tokens, _, empty = hmm_lm._totals(counted, top_words)
    model = hmm_lm._fit(segments, empty, tokens, states, hmm_lm.PASSES)
    count = collections.Counter(w for i, t in data if not hmm_lm.held_out(i) for w in [*t.lower().split(), None])

    def parts(text):
        column = hmm_lm.pa.array([text])
        w = hmm_lm.common.Words(column, lower=True)
        vocabulary, endings = np.append(w.hashes(), hmm_lm._END_HASH), np.append(hmm_lm._endings(w), 0)
        return model.classes(vocabulary, endings)

    shared = collections.defaultdict(set)
    for w in count:
        c = int(parts(w or "")[0])
        shared[c].add(w)

    def within(word, c):
        if c > hmm_lm.ENDINGS:
            return 1.0
        mass, kinds = sum(count[x] for x in shared[c]), len(shared[c])
        return (count[word] + 0.5) / (mass + 0.5 * (kinds + 1))

    assert all(math.isclose(sum(within(w, c) for w in own) + within("never seen", c), 1) for c, own in shared.items() if c <= hmm_lm.ENDINGS)
    assert math.isclose(model.start.sum(), 1) and np.allclose(model.move.sum(1), 1) and np.allclose(model.emit.sum(0), 1)
    for i, t in data:
        words = [*t.lower().split(), None]
        if len(words) > 8:
            continue
        seen = parts(t).tolist()
        total = sum(model.start[s[0]] * math.prod(model.move[a, b] for a, b in itertools.pairwise(s)) * math.prod(model.emit[o, k] for o, k in zip(seen, s, strict=True)) for s in itertools.product(range(states), repeat=len(words)))
        assert math.isclose(got[i], math.log10(total) + sum(math.log10(within(w, c)) for w, c in zip(words, seen, strict=True)), rel_tol=1e-6), (i, t)


def first_states(docs, states, top_words):
    """(states before Baum-Welch, the classes of a text)."""
    segments = hmm_lm.common.settle(hmm_lm._segments(docs), "test-segments")
    tokens, _, one = hmm_lm._totals(hmm_lm.common.settle(hmm_lm._corpus_counts(segments, 3, top_words), "test-counts"), top_words)
    model = hmm_lm._fit(segments, one, tokens, states, 0)

    def classes(text):
        w = hmm_lm.common.Words(hmm_lm.pa.array([text]), lower=True)
        return model.classes(np.append(w.hashes(), hmm_lm._END_HASH), np.append(hmm_lm._endings(w), 0))

    return model, classes


def test_op7_first_states_are_a_mixture_of_all_training_documents(rows, corpus):
    """Against the mixture's steps, document by document; a row that occurs twice counts twice."""
    data = [*corpus, *corpus[:3], (None, "no id"), (900, None), (901, "Ka " * 300)]
    model, classes = first_states(rows("doc_id long, text string", *data).repartition(5), 3, 20)
    texts = [classes(t or "") for i, t in data if not hmm_lm.held_out(i)]
    c, k = model.emit.shape
    count = np.array([np.bincount(t, minlength=c) for t in texts])
    emit = (count.sum(0)[:, None] + 0.1) * np.exp(np.random.default_rng(7).uniform(-1, 1, (c, k)))
    emit, start = emit / emit.sum(0), np.full(k, 1 / k)
    for _ in range(hmm_lm.MIXTURES):
        share = np.array([[w * math.exp(0.2 * x) for w, x in zip(start, own - own.max(), strict=True)] for own in count @ np.log(emit)])
        share /= share.sum(1, keepdims=True)
        emit = np.stack([sum(own * s for own, s in zip(count, share[:, j], strict=True)) for j in range(k)], 1) + 0.1
        emit, start = emit / emit.sum(0), share.mean(0) + 1e-3
        start /= start.sum()
    assert np.allclose(model.emit, emit, rtol=1e-6) and np.allclose(model.start, start, rtol=1e-6)


def test_op7_first_states_know_a_very_long_document(rows):
    """400,002 tokens in one document: longer than what the states were once begun from."""
    short = [(i, "the quick fox " * 20) for i in range(200) if not hmm_lm.held_out(i)]
    long = next(i for i in itertools.count(1000) if not hmm_lm.held_out(i))
    model, classes = first_states(rows("doc_id long, text string", *short, (long, "zig " * 200_000 + "zag " * 200_001)), 2, 10)
    zig, zag = classes("zig zag")[:2]
    assert model.emit[[zig, zag]].max(1).min() > 0.4


def test_op7_beats_the_base_on_held_out_texts(spark):
    got = hmm_lm.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_op8_held_out_pages():
    chain = html_crf.default_chain()
    pages = html_crf.labelled_pages(150, seed=99)
    right = sum((chain.decode(p) == np.array(y)).sum() for p, y in pages if p)
    assert right > 0.97 * sum(len(y) for _, y in pages)


def test_op8_rows(rows):
    page = "<html><body><nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>Title  of&amp;it</h1><p>One <b>bold<br>word.<p>Two\n words &eacute;.</article><script>var a='<p>no</p>'</script><footer>&copy; us</footer>"
    html = [page, None, "", "<<<>", "plain words with no tag at all, and more of them.", page * 40]
    got = html_crf.extract_pages(rows("page_id long, url string, html string, text string", *[(i, None, h, "?") for i, h in enumerate(html)])).orderBy("page_id").collect()
    assert got[0].text == "Title of&it\n\nOne bold word.\n\nTwo words é." and got[0].n_chars == len(got[0].text)
    assert [r.text for r in got[1:3]] == ["", ""] and len(got) == len(html)
    assert html_crf.extract_pages(rows("page_id long, url string, html string")).count() == 0


def test_op8_raw_elements_end_at_their_own_end_tag(rows):
    loops = ["<script>for(i=0;i<n;i++){f(i)}</script>", "<SCRIPT>if(a<b)s='it\"s</p>'</Script >", "<style>p::before{content:'</script>\"'}</style>", "<textarea>x<y \"</textareas></textarea>"]
    body = "<p>One two three words of the main text.</p>{}<p>Four five six words of the same text.</p>"
    for loop in loops:
        page = f"<html><head>{loop}</head><body>{loop}<article>{body.format(loop)}</article>{loop}</body></html>"
        assert [b.text for b in html_crf.blocks(page)] == ["One two three words of the main text.", "Four five six words of the same text."], loop
    got = html_crf.extract_pages(rows("page_id long, url string, html string", (1, "u", f"{loops[0]}<article>{body.format(loops[0])}</article>"))).collect()
    assert got[0].text == "One two three words of the main text.\n\nFour five six words of the same text."
    assert [b.text for b in html_crf.blocks("<p>kept</p><SCRIPT>if(a<b){}</scripts><p>after a script that never ends</p>")] == ["kept", "after a script that never ends"]
    assert [b.text for b in html_crf.blocks("<p>It<wbr>em</p><!--><p title=Bob's>it's</p><p>on</p>")] == ["Item", "it's", "on"]


def test_op8_viterbi_is_the_best_path():
    chain = html_crf.default_chain()
    page = html_crf.labelled_pages(1, seed=3)[0][0][:8]
    unary = [sum(chain.weight.get(f, 0) for f in own) for own in html_crf.features(page)]

    def score(y):
        return chain.begin[y[0]] + chain.finish[y[-1]] + sum(u for u, k in zip(unary, y, strict=True) if k) + sum(chain.moves[a, b] for a, b in zip(y, y[1:], strict=False))

    best = max(itertools.product((0, 1), repeat=len(page)), key=score)
    assert math.isclose(score(best), score(chain.decode(page).tolist()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.common.settle(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns and 0 < docs.count() <= before
    bodies = ["".join(WORD.findall(r.text)) for r in docs.collect()]
    assert len(set(bodies)) == len(bodies)
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() == docs.count()


def test_pipeline_rows_after_each_stage(spark, tmp_path):
    """Every row that a stage keeps, drops or masks, by brute force; without labels the base rules alone judge."""
    rnd = random.Random(3)
    write = lambda n: " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(400)}" for _ in range(n))
    live, copied = "Zx9Zx9Zx9Zx9Zx9Zx9Zx9", "q1w2e3r4t5y6u7i8o9p0zz"
    texts = [write(n) for n in (49, 50, 51, 60, 200, 300, 3000, 10, 0)] + ["so it goes " * 40, write(60) + " so it goes" * 19, write(60) + " so it goes" * 21]
    texts += [texts[4].replace(" ", "\n"), texts[4].replace(" ", "  ", 7), texts[5].replace(texts[5].split()[100], "other"), texts[4] + " more", write(80) + f" key {live} end"]
    texts += [f"{write(90)} copied {copied}" for _ in range(4)]
    ids = rnd.sample(range(1000), len(texts))
    docs = [(i, t, "en", f"s{n % 4}", len(t)) for n, (i, t) in enumerate(zip(ids, texts, strict=True))] + [(None, write(70), "en", "s0", 1)]
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, ddl).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")

    def good(d):
        b = brute_statistics(d[1])
        return not (b[0] < 50 or 100 * b[4] > 50 * b[0])

    want = {"quality": [d for d in docs if good(d)]}
    keep = {r[1] for r in brute_exact([d[:2] for d in want["quality"]])[0]}
    want["exact_dedup"] = [d for d in want["quality"] if d[0] in keep]
    near = {i for i, _, c in brute_near([d[:2] for d in want["exact_dedup"]], 5) if i == c}
    want["near_dedup"] = [d for d in want["exact_dedup"] if d[0] in near]
    want["secrets"] = [(i, t.replace(live, "[SECRET]"), lang, source, len(t.replace(live, "[SECRET]")) if live in t else n) for i, t, lang, source, n in want["near_dedup"]]
    assert len(docs) > len(want["quality"]) > len(want["exact_dedup"]) > len(want["near_dedup"]) and want["secrets"] != want["near_dedup"]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.common.settle(stage(spark, now, str(tmp_path)), f"rows-{name}")
        assert sorted(map(str, map(tuple, now.collect()))) == sorted(map(str, want[name])), name
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.WORD_MODEL))
    pieces = []
    for i, t, *_ in want["secrets"]:
        own = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        pieces += [(i, k // 2048, k, len(own[k : k + 2048]), zlib.crc32(own[k : k + 2048].tobytes())) for k in range(0, len(own), 2048)]
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, pieces))


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_and_empty_rows(spark, awkward, stage):
    stage[1](spark, awkward, SF).collect()
    assert stage[1](spark, awkward.limit(0), SF).count() == 0
