import random

import pytest

#: Null, empty, blank, one word, repeated rows, a repeated id with another text, a null id, a long text, marks.
LONG = " ".join(f"w{i % 977}x{i * 7919 % 10007}" for i in range(30_000))
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "same text here now"), (5, "same text here now"), (5, "another text"), (None, "no id at all"), (None, None),
    (6, LONG), (7, "é ü 日本 😀 'quoted' it's <|endoftext|> done"), (8, "a" * 5000), (9, "same text here now"), (10, "x " * 3000),
]


@pytest.fixture
def awkward(rows):
    """Awkward rows, with extra columns that bear the operators' own names."""
    extra = "rid string, rep string, band string, kept string, c0 string, text_sha256 string, owner string, spans string, carried string, id string"
    n = len(extra.split(","))
    return rows(f"doc_id long, text string, {extra}, source string", *[(i, t, *["?"] * n, "s") for i, t in AWKWARD])


@pytest.fixture
def empty(rows):
    return rows("doc_id long, text string, source string")


@pytest.fixture(scope="session")
def corpus():
    """Random texts with exact copies, near copies, shared passages and ties."""
    rnd = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "ka lo mi ne pu ra".split() for b in "da fe gi ho ju".split()]
    shared = [" ".join(rnd.choice(vocabulary) for _ in range(30)) for _ in range(4)]
    texts = []
    for _ in range(160):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 8, 20, 60, 200]))]
        if rnd.random() < 0.3:
            words[rnd.randrange(len(words) + 1) : 0] = rnd.choice(shared).split()
        texts.append(" ".join(words))
    for _ in range(60):
        words = rnd.choice(texts).split()
        for _ in range(rnd.randrange(4)):
            if words:
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        texts.append(rnd.choice([" ", "\n", "  "]).join(words))
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    return list(zip(ids, texts, strict=True))
