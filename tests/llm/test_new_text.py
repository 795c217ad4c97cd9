"""Line dedup, alignment of tokenizers and the conversation trie against brute force."""

import hashlib
from collections import defaultdict

import random
import zlib

import numpy as np
import pytest

from beaconlake.llm import line_dedup, prefix_trie, token_alignment
from beaconlake.llm.common import written
from beaconlake.llm.queries import ORACLE, QUERIES

from . import plain


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(plain.odd_rows(), plain.ODD_SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], plain.ODD_SCHEMA)


# 13 line dedup

def plain_lines(rows, least_chars=10, least_docs=2):
    """[(doc_id, n_lines, n_dropped, kept_text)]"""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(plain.LOWER)

    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = []
        for line in lines:
            who = holders[key(line)]
            first = min((x for x in who if x is not None), default=None)
            if len(key(line)) < least_chars or len(who) < least_docs or d == first:
                keep.append(line)
        out.append((d, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def same_lines(got, rows, *parameters):
    assert sorted(map(repr, ((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got))) \
        == sorted(map(repr, plain_lines(rows, *parameters)))


LINES = [
    (3, "Gemeinsame Zeile\nnur hier im Text\n\n  GEMEINSAME zeile \t\nkurz"),
    (1, "gemeinsame zeile\nkurz\nnoch eine eigene Zeile"), (2, None), (4, ""), (5, "\n\n"),
    (6, "gemeinsame zeile"), (6, "gemeinsame zeile"), (6, "anderer Text, gleiche Nummer"),
    (None, "gemeinsame zeile\nohne Nummer zweimal"), (None, "ohne Nummer zweimal"),
    (7, "ÄÖÜäöüßéèê\nneun  zei"), (8, "x ÄÖÜäöüßéèê\n ÄÖÜäöüßéèê\r\nneun  zei"),
    (9, "zehn zeich\nzehn zeich"), (10, "Zehn Zeich"), (11, "\x1czehn zeich"), (12, "a\r\nb\rc d"),
]


@pytest.mark.parametrize("support", [line_dedup.SUPPORT, 0.15, 1.0])
def test_lines_of_several_documents_stay_once(spark, support):
    rows = spark.createDataFrame(LINES, "doc_id long, text string")
    same_lines(line_dedup.without_repeated_lines(rows, support=support).collect(), LINES)


def test_lines_by_other_thresholds(spark):
    rows = spark.createDataFrame(LINES, "doc_id long, text string")
    for least_chars, least_docs in ((1, 2), (5, 3), (10, 4)):
        got = line_dedup.without_repeated_lines(rows, least_chars, least_docs).collect()
        same_lines(got, LINES, least_chars, least_docs)


def test_lines_of_the_table(spark, sf_dir, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = QUERIES["op13_line_dedup"](spark, sf_dir).collect()
    want = [(d, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, n, m, t in plain_lines(rows)]
    assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got) == sorted(want)
    assert sum(m for _, _, m, _ in want) > 0


def test_lines_of_odd_rows(odd, none):
    rows = [(r[0], r[1]) for r in plain.odd_rows()]
    same_lines(line_dedup.without_repeated_lines(odd).collect(), rows)
    assert line_dedup.without_repeated_lines(none).collect() == []


def test_a_long_text_with_many_lines(spark):
    text = "\n".join(f"eine lange Zeile {i}" for i in range(60_000))
    other = "\n".join(f"eine lange Zeile {i}" for i in range(0, 60_000, 2))
    rows = [(1, other), (2, text)]
    same_lines(line_dedup.without_repeated_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


# 11 alignment of two tokenizers

@pytest.fixture(scope="module")
def libraries():
    """Ids by the contract's own libraries, and the bytes of each id from the vocabulary files."""
    import json

    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    a = Tokenizer.from_file(path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in printable}
    for n, x in enumerate(x for x in range(256) if x not in printable):
        byte_of[chr(256 + n)] = x
    with open(path, encoding="utf-8") as file:
        vocabulary = {i: t for t, i in json.load(file)["model"]["vocab"].items()}

    def ids(text):
        return a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)

    def spelled_a(i):
        return bytes(byte_of[c] for c in vocabulary[i])

    def spelled_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode()
    return ids, spelled_a, spelled_b


def plain_alignment(rows, libraries):
    """[(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)]"""
    ids, spelled_a, spelled_b = libraries
    documents, counts = [], defaultdict(int)
    for d, t in rows:
        a, b = ids(t) if t else ([], [])
        bytes_a, bytes_b = [spelled_a(i) for i in a], [spelled_b(i) for i in b]
        if not t or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            documents.append((d, [], [], [], []))
            continue
        ends_a = np.cumsum([len(x) for x in bytes_a]).tolist()
        ends_b = np.cumsum([len(x) for x in bytes_b]).tolist()
        place_a, place_b = ({e: k + 1 for k, e in enumerate(ends)} for ends in (ends_a, ends_b))
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i_end, j_end = place_a[end], place_b[end]
            groups.append((a[i:i_end], b[j:j_end]))
            i, j = i_end, j_end
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        for pair in set(links):
            counts[pair] += 1
        documents.append((d, a, b, groups, links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for d, a, b, groups, links in documents:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((d, len(a), len(b), len(groups), len(links),
                    sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


ALIGNMENT = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
TOKENS = [
    (1, None), (2, ""), (3, " "), (4, "\n"), (5, "a <|endoftext|> b <s> </s> <unk>"), (6, "x\u2581y"),
    (7, "  doppelt  und   dreifach\t\tTab \r\n"), (8, "漢字 ü é 🙂👩‍👩‍👧 \x00\x7f"), (9, "=" * 700),
    (10, "zahl 12345678901234567890 und 3.14159"), (11, "q" * 3000), (12, " vorne"), (12, " vorne"),
    (None, "ohne Nummer"), (13, "don't we're I'll"), (14, "\u3000\u00a0\u2028 weiter"),
]


def alignments(df):
    return sorted(tuple(repr(r[c]) for c in ALIGNMENT) for r in df.collect())


def plain_texts(rows, libraries):
    return sorted(tuple(map(repr, r)) for r in plain_alignment(rows, libraries))


def test_crossings_cut_the_merge_into_equal_pieces():
    rng = random.Random(3)
    for n, m in ((0, 0), (0, 9), (9, 0), (50, 50), (200, 3), (3, 200)):
        a = np.array(sorted(rng.sample(range(1000), n)), np.int64)
        b = np.array(sorted(rng.sample(range(1000), m)), np.int64)
        for piece in (1, 2, 7, 64):
            i, j = token_alignment.crossings(a, b, piece)
            assert (i[0], j[0], i[-1], j[-1]) == (0, 0, n, m)
            assert ((np.diff(i) + np.diff(j))[:-1] == piece).all()
            merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
            assert all(i[k] == sum(s == 0 for _, s in merged[: k * piece]) for k in range(len(i) - 1))


def test_groups_do_not_depend_on_pieces():
    rng = random.Random(4)
    for _ in range(30):
        a, b = (np.array(sorted({*rng.sample(range(1, 120), rng.randint(1, 60)), 120})) for _ in "ab")
        cuts = sorted(set(a.tolist()) & set(b.tolist()))
        for piece in (1, 2, 3, 10, 1000):
            in_a, in_b = token_alignment.groups(a, b, piece)
            assert in_a.tolist() == [sum(c < x for c in cuts) for x in a]
            assert in_b.tolist() == [sum(c < x for c in cuts) for x in b]


@pytest.mark.parametrize("held", [0, 40, token_alignment.HELD])
def test_alignment_of_few_texts(spark, libraries, held):
    rows = spark.createDataFrame(TOKENS, "doc_id long, text string")
    assert alignments(token_alignment.alignment_report(rows, held=held)) == plain_texts(TOKENS, libraries)


def test_alignment_of_the_table(spark, sf_dir, docs, libraries):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = QUERIES["op11_token_alignment"](spark, sf_dir)
    assert set(got.columns) == set(ALIGNMENT)
    assert alignments(got) == plain_texts(rows, libraries)


def test_alignment_of_odd_rows(odd, none, libraries):
    rows = [(r[0], r[1]) for r in plain.odd_rows()]
    assert alignments(token_alignment.alignment_report(odd)) == plain_texts(rows, libraries)
    assert token_alignment.alignment_report(none).count() == 0


def test_alignment_in_small_segments_and_chunks(spark, docs, monkeypatch, libraries):
    monkeypatch.setattr(token_alignment, "SEGMENT", 50)
    coder = token_alignment.Encoders()
    for r in [*docs.limit(60).collect(), {"text": "  zwei  Leerzeichen " * 40}, {"text": "q" * 400}]:
        a, b = coder.both(r["text"] or "")
        want = libraries[0](r["text"]) if r["text"] else ([], [])
        assert (a.tolist(), b.tolist()) == (list(want[0]), list(want[1]))


def test_links_laid_out_in_parts(monkeypatch):
    rng = np.random.default_rng(5)
    group_a, group_b = np.sort(rng.integers(0, 6, 300)), np.sort(rng.integers(0, 6, 200))
    ids_a, ids_b = rng.integers(0, 20, 300), rng.integers(0, 30, 200)
    args = (ids_a, group_a, ids_b, group_b, np.array([0, 0, 1, 1, 1, 2]), 20, 30)
    whole = token_alignment.links(*args)
    monkeypatch.setattr(token_alignment, "EXPANDED", 40)
    parts = token_alignment.links(*args)
    assert whole.key.tolist() == parts.key.tolist() and whole.times.tolist() == parts.times.tolist()
    assert whole.times.sum() == sum((group_a == g).sum() * (group_b == g).sum() for g in range(6))


def test_tokens_and_group_sizes_of_texts(spark):
    rows = spark.createDataFrame(TOKENS, "doc_id long, text string")
    for r in written(token_alignment.aligned(rows)).collect():
        assert (sum(r["sizes_a"]), sum(r["sizes_b"])) == (len(r["ids_a"]), len(r["ids_b"]))
        assert len(r["sizes_a"]) == len(r["sizes_b"]) == r["n_groups"]


# 12 prefix trie

def plain_trie(rows):
    """Nodes of rows (conv_id, turn, role, text): the result's columns in order."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children, leaves, tokens = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            tokens[node[:d]] += (len(who) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if built[c] == node)))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who),
                    children[node], leaves[node], tokens[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


TRIE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
TURNS = "conv_id long, turn long, role string, text string"


def trie_rows(df):
    return sorted(repr(tuple(r[c] for c in TRIE)) for r in df.collect())


def some_conversations(seed, n, long):
    """Conversations that share beginnings, one with many turns, null turns, roles and texts, ties."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 4, 9, 12])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["a", "b", "a", "ü", None])))
    rows += [(n, t, "user", f"turn {t}") for t in range(long)]
    rows += [(n + 5, t, "user", f"turn {t}") for t in range(long - 3)]
    rows += [(7, None, "user", "first"), (7, None, "user", "early"), (7, 3, "bot", "tie"), (7, 3, "bot", "tie")]
    rows += [(None, 1, "user", "nobody's"), (10, 2, None, "zz"), (10, 2, "user", "a")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [prefix_trie.PART, 6])
def test_trie_of_some_conversations(spark, most):
    rows = some_conversations(1, 60, 90)
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    assert trie_rows(prefix_trie.rebuilt_trie(df, most)) == plain_trie(rows)


def test_a_conversation_over_many_tasks(spark):
    rows = some_conversations(2, 12, 170)
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    stretches = prefix_trie.ordered_turns(df)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        where = stretches.selectExpr("conv_id", "spark_partition_id() as p").distinct().collect()
        assert sum(r["conv_id"] == 12 for r in where) > 1
        got = trie_rows(prefix_trie.rebuilt_trie(df, 60))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert got == plain_trie(rows)


def test_trie_of_few_conversations(spark):
    cases = [
        [(3, 0, "user", "x")], [(0, None, None, None)], [(0, 0, "user", ""), (1, 0, "user", "")],
        [(c, t, "u", "same") for c in range(40) for t in range(3)],
        [(c, t, "u", f"{c}") for c in (4, 9, 14) for t in range(2)],
    ]
    for rows in cases:
        df = spark.createDataFrame([(*r, 9, "y", 1) for r in rows], TURNS + ", depth long, high string, part int")
        assert trie_rows(prefix_trie.rebuilt_trie(df)) == plain_trie(rows)


def test_trie_without_conversations(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        assert prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS)).collect() == []


def test_decomposition_of_random_forests():
    rng = random.Random(6)
    for n in (1, 2, 30, 300):
        for shape in (lambda i: rng.randrange(i), lambda i: i - 1, lambda i: 0, lambda i: max(0, i - rng.randint(1, 3))):
            parent, part = [], []
            for i in range(n):
                alone = i == 0 or rng.random() < 0.05
                up = None if alone else shape(i)
                parent.append(-1 if alone else up)
                part.append(i if alone else part[up])
            part = np.unique(part, return_inverse=True)[1]
            weight = np.array([rng.randint(1, 5) for _ in range(n)])
            values = np.array([[rng.randint(0, 9), 1] for _ in range(n)])
            subtree, want = weight.copy(), values.copy()
            for i in reversed(range(n)):
                if parent[i] >= 0:
                    subtree[parent[i]] += subtree[i]
                    want[parent[i]] += want[i]
            mixed = np.array(rng.sample(range(n), n))
            place = np.argsort(mixed)
            moved = np.array([place[parent[i]] if parent[i] >= 0 else -1 for i in mixed])
            got = prefix_trie.decomposed(moved, part[mixed], weight[mixed], subtree[mixed], values[mixed])
            assert (got == want[mixed]).all()


def test_digests_of_many_ends(spark, monkeypatch):
    rows = [(1, 2, c) for c in range(9, 1300)] + [(1, 3, 5), (2, 2, 12)]
    got = {(r["high"], r["low"]): r["ends_sha256"] for r in prefix_trie.end_digests(
        spark.createDataFrame(rows, "high long, low long, conv_id long").repartition(3)).collect()}
    for node in ((1, 2), (1, 3), (2, 2)):
        ids = ",".join(str(c) for h, low, c in sorted(rows) if (h, low) == node)
        assert got[node] == hashlib.sha256(ids.encode()).hexdigest()


def test_sql_is_given_where_it_can_say_it():
    """Tokenizing is beyond SQL."""
    assert {"op12_prefix_trie", "op13_line_dedup"} <= set(ORACLE)


# 3 toxicity: texts in pieces

def test_long_texts_are_read_in_pieces_of_whole_sentences(spark, docs, monkeypatch):
    from beaconlake.llm import toxicity

    marks = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.train(docs, marks)
    rows = spark.createDataFrame(
        [(r["doc_id"], r["text"]) for r in docs.collect()] + [(-1, "Ein Satz. " * 500 + "é ü!" * 90)],
        "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(toxicity, "OFFENDING", 1e-4)
    whole = toxicity.scored(rows, model).orderBy("doc_id").collect()
    batch = rows.toArrow().combine_chunks().to_batches()[0]
    monkeypatch.setattr(toxicity, "PIECE_BYTES", 300)
    parts = list(toxicity._scorer(model)([batch]))[0]
    got = {d: (s, n, o) for d, s, n, o in zip(*(c.to_pylist() for c in parts.columns))}
    for r in whole:
        score, n, spans = got[r["doc_id"]]
        assert n == r["n_sentences"] and abs(score - r["score"]) < 1e-8
        assert [(x["start"], x["end"]) for x in spans] == [(x["start"], x["end"]) for x in r["offending"]]
    assert sum(len(o) for *_, o in got.values()) > 0


def test_the_fit_does_not_depend_on_pieces(monkeypatch):
    import pyarrow as pa

    from beaconlake.llm import toxicity

    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    texts, toxic = [], []
    for i in range(60):
        text = [" ".join(rng.choices(words, k=6)) for _ in range(rng.choice([1, 3, 30]))]
        if i % 3 == 0:
            text.insert(rng.randrange(len(text) + 1), "böse worte hier " + rng.choice(words))
        texts.append(". ".join(text))
        toxic.append(i % 3 == 0)
    args = pa.array(texts, pa.large_string()), np.array(toxic), np.ones(60)
    whole = toxicity.fit_texts(*args)
    monkeypatch.setattr(toxicity, "PIECE_BYTES", 64)
    parts = toxicity.fit_texts(*args)
    assert whole.weights.any() and np.allclose(whole.weights, parts.weights) and np.isclose(whole.bias, parts.bias)
    # Features by documents, the plain way.
    counts = toxicity.Telling(np.array(toxic))
    held = [(0, 5), (0, 5), (0, 7), (1, 5), (1, 9), (2, 7)]
    for k in range(0, 6, 2):
        counts.add(np.array([d for d, _ in held[k:k + 2]]), np.array([f for _, f in held[k:k + 2]]))
    counts.chosen()
    assert (counts.in_any[[5, 7, 9]] == [2, 2, 1]).all()


def test_the_fit_stays_small_on_64_mb():
    """Peak of the process above what the texts take, in a process of its own."""
    import subprocess
    import sys

    code = """
import resource, sys
import numpy as np, pyarrow as pa
from beaconlake.llm import toxicity
toxicity.STEPS = 3
rng = np.random.default_rng(1)
words = np.array([f"wort{i}" for i in range(50_000)])
texts = []
for i in range(2000):
    w = words[rng.integers(0, 50_000, 3200)]
    w[::12] = np.char.add(w[::12], ".")
    texts.append(" ".join(w) + (" boese worte" if i % 2 else ""))
texts = pa.array(texts, pa.large_string())
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
toxicity.fit_texts(texts, np.arange(2000) % 2 == 1, np.ones(2000))
after = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
print(texts.nbytes >> 20, (after - before) >> 10)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200, check=True)
    size, more = map(int, out.stdout.split())
    assert size >= 55 and more < 400


# 8 secrets: what the grammar adds

def test_precision_and_recall_on_planted_formats_and_decoys(spark):
    """Credentials of a labelled format without a keyword, among strings that look like them."""
    from beaconlake.llm import secret_scans

    rng = random.Random(11)
    letters = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789"
    hexes = "0123456789abcdef"

    def some(signs, n):
        return "".join(rng.choices(signs, k=n))

    formats = [lambda: "ghp_" + some(letters, 36), lambda: "sk-live-" + some(letters, 24),
               lambda: some(letters + "+/", 40)]
    decoys = [
        lambda: some("0123456789", 16), lambda: "-".join(some("0123456789", 4) for _ in range(4)),
        lambda: f"20{some('012', 2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}T1{rng.randint(0, 9)}.{some('0123456789', 6)}",
        lambda: "-".join(some(hexes, n) for n in (8, 4, 4, 4, 12)),
        lambda: f"order-{some('0123456789', 8)}-eu-west", lambda: f"img/2024/photo_{some('0123456789', 5)}.jpeg",
        lambda: f"www.beispiel.org/seite/{rng.randint(1, 9999)}", lambda: some("0123456789", 22),
    ]
    rows = [(i, f'api_key = "{formats[i % 3]()}"') for i in range(300)]
    planted = [(10_000 + i, f"gefunden {formats[i % 3]()} im text") for i in range(60)]
    ordinary = [(20_000 + i, f"nummer {decoys[i % len(decoys)]()} im text") for i in range(4000)]
    got = secret_scans.scanned(spark.createDataFrame(rows + planted + ordinary, "doc_id long, text string")).toPandas()
    found = got[(got.doc_id >= 10_000) & (got.n_format > 0)].doc_id
    right = (found < 20_000).sum()
    assert right / 60 >= 0.9 and right / len(found) >= 0.8
    numbers = {20_000 + i for i in range(4000) if i % len(decoys) in (0, 1, 7)}
    assert not numbers & set(found)


def test_long_labelled_values_are_whole(spark):
    from beaconlake.llm import secret_scans

    value = "Ab3" * 500
    rows = list(secret_scans._examples(iter([spark.createDataFrame(
        [(f"token={value}x y",), (f"token={value}z y",)], "text string").toArrow().combine_chunks().to_batches()[0]])))
    assert sorted(map(len, rows[0].column("value").to_pylist())) == [1501, 1501]
    assert secret_scans.format_of(b"sk-12ab_GH9/77") == b"2l-4h_3m/29"


# 10 near duplicates: a template that a third of the rows share, below the threshold

def test_a_large_bucket_is_dealt_over_tasks(spark, monkeypatch):
    from beaconlake.llm import near_dedup

    rng = random.Random(12)
    template = [f"muster{i}" for i in range(100)]
    rows = []
    for i in range(150):
        own = [f"eigen{rng.randint(0, 10**6)}" for _ in range(25)]
        rows.append((i, " ".join(template + own)))
        if i % 10 == 0:  # and some true links among them
            rows.append((1000 + i, " ".join(template + own[:-1] + ["anders"])))
    rows += [(2000 + i, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60))) for i in range(60)]
    want = plain.near_components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    for together in (1, 3):
        monkeypatch.setattr(near_dedup, "TOGETHER", together)
        got = near_dedup.near_duplicates(df).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
    pairs = spark.createDataFrame([(1, d, 64, d, d % 2 == 0) for d in range(64)],
                                  "key long, doc_id long, size long, component long, apart boolean")
    met = near_dedup._met_in_blocks(pairs, [])
    seen = [(a["doc_id"], b["doc_id"]) for r in met.collect() for a in r["left"] for b in r["right"]]
    assert len(seen) == len(set(seen)) == 32 * 64


# 1 mixing, 3 toxicity: plain versions of what is fitted

def test_raking_equals_plain_proportional_fitting(spark):
    from beaconlake.llm import mixing

    rng = np.random.default_rng(3)
    tokens = rng.integers(50, 900, (4, 3, 2)).astype(float)
    rows = [(f"s{i}", f"l{j}", k, int(tokens[i, j, k])) for i, j, k in np.ndindex(tokens.shape)]
    goals = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.3, 0.2]), np.array([0.6, 0.4])]
    budget = 0.4 * tokens.sum()
    weight = tokens.copy()
    for _ in range(mixing.MAX_TURNS):
        for axis, goal in enumerate(goals):
            others = tuple(x for x in range(3) if x != axis)
            scale = goal * budget / weight.sum(axis=others)
            weight = np.minimum(tokens, weight * scale.reshape([-1 if x == axis else 1 for x in range(3)]))
    cells = spark.createDataFrame(rows, "source string, lang string, topic int, tokens long")
    names = [[f"s{i}" for i in range(4)], [f"l{i}" for i in range(3)], [0, 1]]
    targets = {d: spark.createDataFrame([(v, float(t)) for v, t in zip(n, goal)],
                                        f"value {'int' if d == 'topic' else 'string'}, target double")
               for d, n, goal in zip(mixing.DIMENSIONS, names, goals)}
    got = {(r["source"], r["lang"], r["topic"]): r["weight"]
           for r in mixing.rake(cells, targets, budget).collect()}
    for i, j, k in np.ndindex(tokens.shape):
        assert abs(got[f"s{i}", f"l{j}", k] - weight[i, j, k]) < 3 * mixing.CLOSE * budget


def test_noisy_or_and_its_fit_equal_plain_ones():
    from beaconlake.llm import toxicity

    p, first = np.array([0.1, 0.5, 0.2, 0.9]), np.array([0, 2, 2, 4])
    want = [1 - 0.9 * 0.5, 0.0, 1 - 0.8 * 0.1]
    assert np.allclose(toxicity._noisy_or(p, first), want)
    # Six documents of two sentences; feature 0 is in one sentence of each toxic one.
    sentence = np.repeat(np.arange(12), 2)
    features = np.array([[0, 1], [1, 2]] * 3 + [[1, 2], [2, 1]] * 3).reshape(-1)
    doc, toxic = np.repeat(np.arange(6), 2), np.arange(6) < 3
    model = toxicity.fit(np.array([5, 6, 7]), features, sentence, doc, toxic, np.ones(6))

    def loss(w, bias):
        x = np.zeros(12)
        np.add.at(x, sentence, w[features])
        q = 1 - np.array([np.prod([1 - 1 / (1 + np.exp(-(x[s] + bias))) for s in np.flatnonzero(doc == d)])
                          for d in range(6)])
        return -np.mean(np.log(np.where(toxic, q, 1 - q))) + toxicity.SHRINK / 2 * (w**2).sum()

    w = model.weights[[5, 6, 7]]
    assert w[0] > 1 and loss(w, model.bias) < 0.05
    for step in np.eye(4) * 0.5:  # no step away is better by more than the fit's own remainder
        for sign in (1, -1):
            moved = np.append(w, model.bias) + sign * step
            assert loss(moved[:3], moved[3]) > loss(w, model.bias) - 0.01
