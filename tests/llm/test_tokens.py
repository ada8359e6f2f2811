"""Merge replay, fill-in-middle and token alignment against the libraries and plain definitions."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from llm_cases import DOCS
from tidings.llm import displacement_fim, merge_replay, token_alignment
from tidings.llm.token_cache import processor

SIGNS = ["a", "bc", "Zq", " ", "  ", "\n", "é", "中", "😀", "<", "P", ">", "S", "M", "0", "'s", "▁", "՘", "౜", " ", "ﬁ", "<|endoftext|>", "<P>"]


def texts(seed, n=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.choice([0, 1, 2, 5, 20, 200]))) for _ in range(n)] + [None, "", " ", "a" * 3000, " " * 2001, "ab " * 40000]


@pytest.fixture(scope="module")
def mixed_docs(spark, edge_docs):
    rows = [(1000 + i, t, "en", "s", 1) for i, t in enumerate(texts(5))]
    return edge_docs.select(*DOCS.names).unionByName(spark.createDataFrame(rows, DOCS)).withColumn("refs", F.lit("clash")).withColumn("block", F.lit(1))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def library(ranks=merge_replay.RANKS):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=merge_replay.vocabulary(ranks)[1], special_tokens={})


def none_first(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


# ---- op11 -------------------------------------------------------------------------------

def test_replay_equals_library_word_by_word():
    rng, lib = random.Random(2), library()
    words = ["".join(rng.choice("abcde the ing0 \né") for _ in range(rng.randint(0, 30))).encode() for _ in range(3000)] + [b"a" * 5000, b" " * 3001, b"ab" * 999, b""]
    ids, counts = merge_replay.replay(words)
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [lib._core_bpe.encode_single_piece(w) if w else [] for w in words]


def test_replay_with_ranks_out_of_order(monkeypatch):
    """A token may rank below its parts, and may be reached by no merge."""
    import itertools

    import tiktoken
    rng = random.Random(4)
    many = [bytes(x) for n in (2, 3, 4) for x in itertools.product(b"abc", repeat=n)]
    for _ in range(20):
        rng.shuffle(many)
        rank = {bytes([i]): i + 50 for i in range(256)} | {x: k if k < 50 else 300 + k for k, x in enumerate(many[:60])}
        tokens = [b""] * (max(rank.values()) + 1)
        for t, n in rank.items():
            tokens[n] = t
        monkeypatch.setattr(merge_replay, "vocabulary", lambda _, v=(tokens, rank): v)
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12))) for _ in range(300)]
        ids, counts = merge_replay.replay(words, "own")
        lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=rank, special_tokens={})
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [lib._core_bpe.encode_single_piece(w) for w in words]


@pytest.mark.parametrize("block_bytes, replay_bytes", [(merge_replay.BLOCK_BYTES, merge_replay.REPLAY_BYTES), (700, 50)])
def test_merge_replay_documents(spark, mixed_docs, block_bytes, replay_bytes):
    lib = library()
    coded = merge_replay.decode(merge_replay.encode(mixed_docs.repartition(3), block_bytes=block_bytes, replay_bytes=replay_bytes))
    got = none_first((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in coded.collect())
    want = none_first((i, np.array(lib.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in mixed_docs.select("doc_id", "text").collect())
    assert got == want


def test_merge_replay_query(spark, mixed_docs, no_docs):
    lib = library()
    got = none_first(map(tuple, merge_replay.query(spark, mixed_docs).collect()))
    want = []
    for i, t in mixed_docs.select("doc_id", "text").collect():
        ids = lib.encode_ordinary(t or "")
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t or "")))
    assert got == none_first(want)
    empty = merge_replay.query(spark, no_docs)
    assert empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and empty.count() == 0


def test_splitting_pattern_like_library_on_all_code_points():
    lib, find = library(), merge_replay.splitter()
    for c in [*range(0xD800), *range(0xE000, 0x20000), *range(0xE0000, 0xE0200)]:
        ch = chr(c)
        text = f"a{ch}b 1{ch}2 {ch}{ch}x !{ch}! \n{ch} y{ch}'s {ch}'{ch}1"
        assert [i for w in find(text) for i in lib._core_bpe.encode_single_piece(w.encode())] == lib.encode_ordinary(text), hex(c)


# ---- op12 -------------------------------------------------------------------------------

def fim(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("window", [7, displacement_fim.WINDOW])
def test_scatter_and_gather(monkeypatch, window):
    """Windows that cut texts, tokens and spans anywhere give the same bytes."""
    monkeypatch.setattr(displacement_fim, "WINDOW", window)
    rng = random.Random(9)
    for trial in range(60):
        some = [t or "" for t in texts(trial, 8)[:8]]
        ids = [rng.randrange(10**6) for _ in some]
        raw = np.frombuffer("".join(some).encode(), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in some])]).astype(np.int64)
        h = [np.array([int(sha(f"1:{i}")[8 * k:8 * k + 8], 16) for i in ids]) for k in range(4)]
        n, form, prefix, middle, to, out = displacement_fim.scatter(raw, offsets, h)
        for k, (i, t) in enumerate(zip(ids, some)):
            want = fim(i, t)
            assert (n[k], displacement_fim._FORMS[form[k]], bytes(out[to[k]:to[k + 1]]).decode()) == (want[0], want[1], want[4])
            assert not form[k] or (prefix[k], middle[k]) == want[2:4]
        back_to, back = displacement_fim.gather(out, to, form)
        assert bytes(back) == bytes(raw) and list(back_to) == list(offsets)


def test_fill_in_middle_documents(spark, mixed_docs, no_docs):
    rows = displacement_fim.restore(displacement_fim.fill_in_middle(mixed_docs.repartition(2))).collect()
    want = none_first((i, *fim(i, t), t or "") for i, t in mixed_docs.select("doc_id", "text").collect())
    assert none_first(map(tuple, rows)) == want
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    got = none_first(map(tuple, displacement_fim.query(spark, mixed_docs).collect()))
    assert got == none_first((i, n, f, p, m, sha(o), sha(t)) for i, n, f, p, m, o, t in want)
    assert displacement_fim.query(spark, no_docs).count() == 0


def test_restore_needs_output_and_form_only(spark):
    made = spark.createDataFrame([("<S>c<P>a<M>b", "spm"), ("<P><S><M>", "psm"), ("<P>x", "plain"), (None, None)], "output string, form string")
    assert [r.restored for r in displacement_fim.restore(made).collect()] == ["abc", "", "<P>x", ""]


# ---- op13 -------------------------------------------------------------------------------

def spelled_tokens(doc_texts):
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(P.path(token_alignment.LEFT)), processor(token_alignment.RIGHT)
    a.encode_special_tokens = True
    kept = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in kept} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in kept)}
    for t in doc_texts:
        if not t:
            yield [], []
            continue
        left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
        right = [(i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()) for i in b.encode(t) for p in [b.id_to_piece(i)]]
        ok = b"".join(x for _, x in left) == b"".join(x for _, x in right) == (" " + t).encode()
        yield (left, right) if ok else ([], [])


def aligned(rows):
    """The contract, token by token."""
    done, docs_of = [], Counter()
    for (i, t), (a, b) in zip(rows, spelled_tokens([t for _, t in rows])):
        a_end, b_end = (list(np.cumsum([len(x) for _, x in side])) for side in (a, b))
        common = sorted(set(a_end) & set(b_end))
        groups = [([], []) for _ in common]
        for side, ends, tokens in ((0, a_end, a), (1, b_end, b)):
            at = 0
            for (token, _), e in zip(tokens, ends):
                while common[at] < e:
                    at += 1
                groups[at][side].append(token)
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        overlaps = sum(max(u0, v0) < min(u, v) for u, u0 in zip(a_end, [0, *a_end]) for v, v0 in zip(b_end, [0, *b_end])) if len(a) < 500 else None
        docs_of.update(links.keys())
        done.append((i, groups, links, overlaps))
    best = defaultdict(int)
    for (x, _), n in docs_of.items():
        best[x] = max(best[x], n)
    for i, groups, links, overlaps in done:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
               sum(n for k, n in links.items() if docs_of[k] == best[k[0]]), sum(n * docs_of[k] for k, n in links.items()), sha(text) if groups else "", overlaps)


@pytest.fixture(scope="module")
def alignment_truth(mixed_docs):
    return list(aligned([tuple(r) for r in mixed_docs.select("doc_id", "text").collect()]))


@pytest.mark.parametrize("block_bytes, run_bytes", [(token_alignment.BLOCK_BYTES, token_alignment.RUN_BYTES), (900, 300)])
def test_alignment(spark, mixed_docs, alignment_truth, monkeypatch, block_bytes, run_bytes):
    monkeypatch.setattr(token_alignment.align, "__defaults__", (token_alignment.LEFT, token_alignment.RIGHT, block_bytes, run_bytes))
    got = none_first(tuple(r) for r in token_alignment.query(spark, mixed_docs.repartition(2)).collect())
    want = none_first(alignment_truth)
    assert [r[:8] for r in got] == [r[:8] for r in want]
    assert sorted((r[0], r[8]) for r in want if r[8] is not None and r[0] is not None) == sorted((r[0], r[8]) for r, w in zip(got, want) if w[8] is not None and r[0] is not None)
    assert {r[1] > 0 for r in got} == {True, False}


def test_alignment_of_nothing(spark, no_docs):
    assert token_alignment.query(spark, no_docs).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, token_alignment.query(spark, blank).collect())) == [(1, 0, 0, 0, 0, 0, 0, "", 0), (2, 0, 0, 0, 0, 0, 0, "", 0)]


def test_products_like_dense_matrices():
    rng = np.random.default_rng(3)
    for at_once in (1, 5, 1000):
        x, y = rng.integers(0, 4, (6, 7)) * rng.integers(0, 2, (6, 7)), rng.integers(0, 4, (7, 5)) * rng.integers(0, 2, (7, 5))
        rows = [(np.repeat(np.nonzero(m)[0], m[np.nonzero(m)]), np.repeat(np.nonzero(m)[1], m[np.nonzero(m)])) for m in (x, y)]
        a, b = token_alignment.incidence(*rows[0], *x.shape), token_alignment.incidence(*rows[1], *y.shape)
        dense = np.zeros((6, 5), np.int64)
        for r, c, v in token_alignment.product(a, b, at_once):
            dense[r, c] += v
        assert (dense == x @ y).all()
        back = token_alignment.transposed(token_alignment.transposed(a))
        assert all((np.asarray(u) == np.asarray(v)).all() for u, v in zip(back, a))


def test_many_tokens_in_one_group_count_all_links():
    """Ends that never meet: one group, its links counted by distinct ids."""
    table = token_alignment.tables(token_alignment.LEFT, token_alignment.RIGHT)
    two, three = table.a_bytes.index(b"00"), table.b_bytes.index(b"0")
    found = token_alignment.align_tokens(table, [[two] * 600], [[three] * 1200], products=64)
    assert found.n_groups[0] == 600 and found.links.tolist() == [1200] and found.n_overlaps[0] == 1200


def test_left_ids_like_the_library_on_whole_texts():
    """Neither cutting at a space between printable ASCII signs nor ranks for Latin words change the left tokenizer's ids."""
    table = token_alignment.tables(token_alignment.LEFT, token_alignment.RIGHT)
    rng = random.Random(6)
    latin = [t.decode() for t in table.a_bytes if t.decode(errors='ignore').encode() == t]
    some = ["".join(rng.choice(latin) if rng.random() < 0.7 else chr(rng.randrange(0x250)) for _ in range(rng.randint(1, 30))) for _ in range(20000)]
    some += [t for t in texts(11, 200) if t] + [f"a{chr(c)} b{chr(c)}c d {chr(c)} e  f !" for c in range(0x21, 0x3000)]
    some += [f"a{chr(c)}'s {chr(c)}{chr(c)}1 {chr(c)}'s\n{chr(c)} {chr(c)}.{chr(c)}" for c in range(0x250)]
    whole = [e.ids for e in table.a.encode_batch([" " + t for t in some], add_special_tokens=False)]
    assert [x.tolist() for x in table.encode(some, {})[0]] == whole


def test_alignment_sorts_and_spells_once(monkeypatch):
    """Texts of Latin signs are not spelled token by token on the left, group borders and id rows need one sort; the result is the plain one."""
    from tidings.llm import token_alignment as T
    table = T.tables(T.LEFT, T.RIGHT)
    texts = ["The quick  brown fox, the quick fox.", "caf\u00e9 12345\n\tx", "", "\u4e2d\u6587 and the fox", "a" * 300]
    a, b = table.encode(texts, {})
    spelled = []
    monkeypatch.setattr(T.Tables, "spells", lambda self, ids, names, text: spelled.append(text) or b"".join(names[ids].tolist()) == text)
    assert [table.left_spells(x, t, b" " + t.encode()) for x, t in zip(a, texts)] == [True] * 5 and spelled == [" \u4e2d\u6587 and the fox".encode()]
    assert not table.left_spells(a[0][1:], texts[0], b" " + texts[0].encode())
    a[2], b[2] = np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = T.align_tokens(table, a, b, 7)
    for k in range(5):
        one = T.align_tokens(table, a[k:k + 1], b[k:k + 1])
        at = slice(whole.pair_ends[k - 1] if k else 0, whole.pair_ends[k])
        assert one.groups[0] == whole.groups[k] and one.pairs.tolist() == whole.pairs[at].tolist() and one.links.tolist() == whole.links[at].tolist()
        assert (one.n_groups[0], one.n_overlaps[0]) == (whole.n_groups[k], whole.n_overlaps[k])
