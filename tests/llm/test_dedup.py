"""Exact, near and passage deduplication against brute force."""

import hashlib
import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from quillstone.llm import exact_dedup, near_dedup, substring_dedup
from quillstone.llm.components import components
from quillstone.llm.exact_dedup import PatriciaTrie

from .conftest import AWKWARD


def words_of(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=6)))
def test_trie_keeps_keys_apart(keys):
    trie = PatriciaTrie()
    for k in keys:
        node = trie.insert(k)
        node.value = (node.value or 0) + 1
    assert all(trie.insert(k).value == keys.count(k) for k in keys)


def brute_exact(data):
    groups = {}
    for n, (i, t) in enumerate(data):
        groups.setdefault(b"".join(words_of(t)), []).append((-len(t or ""), i is None, i or 0, n))
    out = []
    for content, members in groups.items():
        best = min(members)
        out += [(m[2] if not m[1] else None, best[2] if not best[1] else None, len(members), hashlib.sha256(content).hexdigest()) for m in members]
    return out, len(groups)


def check_exact(df, data, **options):
    got = exact_dedup.exact_duplicates(df, **options).collect()
    want, n = brute_exact(data)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got])) == sorted(map(key, want))
    assert sum(r.kept for r in got) == n and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_op6(rows, awkward, empty, corpus):
    check_exact(awkward, AWKWARD)
    docs = rows("doc_id long, text string", *corpus).repartition(5)
    check_exact(docs, corpus)
    check_exact(docs, corpus, held_bytes=3000)  # every subtree is spilled again and again
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_op6_survivors_keep_their_columns(awkward, empty):
    kept = exact_dedup.drop_exact_duplicates(awkward)
    assert kept.columns == awkward.columns and kept.count() == brute_exact(AWKWARD)[1]
    assert kept.where("rid <> '?'").count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0


def brute_near(data, size, percent=80):
    sets = []
    for i, t in data:
        w = words_of(t, True)
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(data)), 2):
        same_id = data[a][0] is not None and data[a][0] == data[b][0]
        shared = len(sets[a] & sets[b])
        linked = shared and None not in (data[a][0], data[b][0]) and 100 * shared >= percent * len(sets[a] | sets[b])
        if linked or same_id and sets[a] and sets[b]:
            root[find(b)] = find(a)
    least = {}
    for n, (i, _) in enumerate(data):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return [(i, len(sets[n]), None if i is None else i if not sets[n] else least[find(n)]) for n, (i, _) in enumerate(data)]


def check_near(df, data, size):
    got = near_dedup.near_groups(df, size).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, [(r.doc_id, r.n_shingles, r.component_id) for r in got])) == sorted(map(key, brute_near(data, size)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_op10(rows, awkward, empty, corpus):
    check_near(rows("doc_id long, text string", *corpus), corpus, 2)
    check_near(rows("doc_id long, text string", *corpus), corpus, 5)
    check_near(awkward, AWKWARD, 2)
    assert near_dedup.near_groups(empty).count() == 0


def test_op10_finds_links_that_avoid_the_pivot(rows):
    """A chain: neighbours are alike, its ends are not, and the smallest id stands in the middle."""
    base = [f"t{i}" for i in range(120)]
    chain = [(100 + k if k != 6 else 1, " ".join(base[3 * k : 3 * k + 60])) for k in range(13)]
    chain = [(i, t) for i, t in chain] + [(500, " ".join(f"u{i}" for i in range(60)))]
    check_near(rows("doc_id long, text string", *chain), chain, 2)


def test_op10_rows_grow_with_the_group_and_not_with_its_pairs(rows, monkeypatch):
    """Copies of one text with some words changed: what is compared with pivots and what stays open doubles with the group at most."""
    rnd = random.Random(12)
    base = [f"b{i}" for i in range(150)]
    copies = []
    for i in range(320):
        words = list(base)
        for k in rnd.sample(range(150), rnd.randrange(2, 16)):
            words[k] = f"x{i}_{k}"
        copies.append((i, " ".join(words)))
    settle, seen = near_dedup.common.settle, {}

    def counted(df, name):
        out = settle(df, name)
        seen[name] = seen.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(near_dedup.common, "settle", counted)
    sizes = []
    for n in (160, 320):
        seen.clear()
        check_near(rows("doc_id long, text string", *copies[:n]), copies[:n], 2)
        sizes.append({k: v for k, v in seen.items() if k in ("near-bands", "near-stars", "near-open")})
    assert all(sizes[1][k] <= 2.5 * max(sizes[0][k], 160) for k in sizes[1]), sizes


def test_op10_deals_a_large_open_bucket_into_blocks(rows, monkeypatch):
    """Chains whose ends meet no pivot, in as many blocks as members: no link may be lost between blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 400)
    chains = [(1000 * (c + 1) + (7 * k) % 13 + (0 if k != 6 else -900), " ".join(f"t{c}_{i}" for i in range(3 * k, 3 * k + 60))) for c in range(2) for k in range(13)]
    check_near(rows("doc_id long, text string", *chains), chains, 2)


def test_op10_survivors(awkward, corpus, rows):
    kept = near_dedup.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns and kept.where("doc_id is null").count() == 2
    docs = rows("doc_id long, text string", *corpus)
    want = {i for i, _, c in brute_near(corpus, 5) if i == c}
    assert {r.doc_id for r in near_dedup.keep_one_of_each(docs).collect()} == want


def test_components(rows):
    edges = [(b, a) for a, b in zip(range(1, 40), range(2, 41), strict=True)] + [(100, 101), (102, 101), (None, 5)]
    got = {r.node: r.component for r in components(rows("a long, b long", *edges)).collect()}
    assert got == {n: 1 for n in range(2, 41)} | {101: 100, 102: 100}
    assert components(rows("a long, b long")).count() == 0


def test_suffix_automaton():
    text = [1, 2, 3, 1, 2, 4, 2, 3]
    probe = [9, 1, 2, 3, 1, 2, 3, 4]
    inside = lambda s: any(text[i : i + len(s)] == s for i in range(len(text)))
    want = [max(n for n in range(k + 2) if inside(probe[k + 1 - n : k + 1])) for k in range(len(probe))]
    assert substring_dedup.SuffixAutomaton(text).matches(probe) == want


def brute_passages(data, window=13):
    first = {}
    for i, t in data:
        if i is not None:
            w = words_of(t)
            for k in range(len(w) - window + 1):
                s = tuple(w[k : k + window])
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in data:
        w = words_of(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return out


def check_passages(df, data):
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(df).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, brute_passages(data)))


def test_op3(rows, awkward, empty, corpus, monkeypatch):
    check_passages(awkward, AWKWARD)
    more = [(1000, AWKWARD[9][1][5000:90_000]), (1001, "x " * 2000), (1002, "y " + "x " * 40 + "y")]
    docs = [*AWKWARD, *more]
    check_passages(rows("doc_id long, text string", *docs), docs)
    check_passages(rows("doc_id long, text string", *corpus).repartition(6), corpus)
    monkeypatch.setattr(substring_dedup, "SEGMENT_WORDS", 200)
    check_passages(rows("doc_id long, text string", *corpus).repartition(2), corpus)
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_op3_windows_whose_hashes_collide(rows, corpus, monkeypatch):
    """With short hashes many windows are sent to look-alikes; the automata refuse those, and other hashes find the true owners."""
    monkeypatch.setattr(substring_dedup, "HASH_BITS", 18)
    check_passages(rows("doc_id long, text string", *corpus).repartition(6), corpus)


def test_op3_shards_of_a_long_document(rows, monkeypatch):
    """Passages that lie across the edges of shards, in documents of many shards, with hot shards in several parts."""
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 50)
    monkeypatch.setattr(substring_dedup, "SHARD_MEMBERS", 2)
    long = [f"w{i * 7919 % 1009}" for i in range(1000)]
    data = [(0, " ".join(long))] + [(1 + k, " ".join([f"own{k}", *long[37 * k : 37 * k + 40 + k], "end"])) for k in range(20)]
    data += [(100 + k, " ".join([f"too{k}", *long[300:330]])) for k in range(6)] + [(200, " ".join(long)), (201, " ".join(long[::-1]))]
    check_passages(rows("doc_id long, text string", *data).repartition(4), data)
    check_passages(rows("doc_id long, text string", *data).coalesce(1), data)
