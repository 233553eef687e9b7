"""Token alignment against overlaps listed pair by pair."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docketline.llm import token_alignment as ta
from docketline.llm.packing import byte_alphabet
from docketline.llm.queries import QUERIES, piece_model, tokenizer_file

TEXTS = [None, "", " ", "word", "Hello, world!  Two  spaces\n\tand é ü 日本語 😀", "a <|endoftext|> b <s> </s> <unk> <0x41>", "▁ under", "x" * 3000,
         "same text here", "same text here", "ﬁ ligature ½", "a\x00b", "word " * 8000, " \n" * 400, "can't we're I'll 12345 ###"]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_str(tokenizer_file())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain(a, b, text):
    """([(id, start, end)] of A, of B), by the libraries' own vocabularies."""
    if not text:
        return [], []
    letters = byte_alphabet()
    out = []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    shown_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    shown_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    for ids, shown in ((ids_a, shown_a), (ids_b, shown_b)):
        if b"".join(shown) != (" " + text).encode():
            return [], []
        at, side = 0, []
        for i, x in zip(ids, shown):
            side.append((i, at, at + len(x)))
            at += len(x)
        out.append(side)
    return out


def brute(a, b, texts):
    rows, held = [], collections.Counter()
    for text in texts:
        xs, ys = plain(a, b, text)
        cuts = sorted({e for _, _, e in xs} & {e for _, _, e in ys})
        groups, start = [], 0
        for cut in cuts:
            groups.append(",".join(str(i) for i, s, e in xs if start <= s and e <= cut) + "|" + ",".join(str(i) for i, s, e in ys if start <= s and e <= cut))
            start = cut
        links, k = [], 0
        for i, s, e in xs:  # both sides are in order
            while k and ys[k - 1][2] > s:
                k -= 1
            while k < len(ys) and ys[k][2] <= s:
                k += 1
            j = k
            while j < len(ys) and ys[j][1] < e:
                links.append((i, ys[j][0]))
                j += 1
        held.update(set(links))
        rows.append((len(xs), len(ys), groups, links))
    top = collections.defaultdict(int)
    for (i, _), c in held.items():
        top[i] = max(top[i], c)
    return [(n, m, len(g), len(x), sum(held[p] == top[p[0]] for p in x), sum(held[p] for p in x), ";".join(g)) for n, m, g, x in rows]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def scored(df, lookup_rows=ta.LOOKUP_ROWS):
    aligned = ta.write(ta.align(df, tokenizer_file(), piece_model()))
    return ta.score(aligned, ta.link_table(aligned), lookup_rows)


def test_all_columns(spark, both):
    texts = [t for t in TEXTS if not t or len(t) < 5000]
    df = spark.createDataFrame([(i if i % 5 else None, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, a int, row string")
    want = collections.Counter(brute(*both, texts))
    for parts in (1, 4):
        got = scored(df.repartition(parts)).collect()
        assert collections.Counter(tuple(r[n] for n in NAMES) for r in got) == want
    assert scored(df.limit(0)).count() == 0


def test_shuffle_join_gives_the_same_rows(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = [sorted(map(str, scored(df, lookup_rows=k).collect())) for k in (ta.LOOKUP_ROWS, 0)]
    assert rows[0] == rows[1]


def test_long_texts_and_documents(spark, both):
    docs = [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts = docs + TEXTS[-4:]
    want = brute(*both, texts)
    got = scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("id").collect()
    assert [tuple(r[n] for n in NAMES) for r in got] == want


def test_query(spark):
    out = QUERIES["op11_token_alignment"](spark, SF001).collect()
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    full = {r["id"]: r for r in scored(docs).collect()}
    assert len(out) == len(full)
    for r in out:
        f = full[r["doc_id"]]
        assert all(r[n] == f[n] for n in NAMES[:-1])
        assert r["groups_sha256"] == (hashlib.sha256(f["groups"].encode()).hexdigest() if f["n_a"] else "")
        assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 60).flatmap(lambda n: st.tuples(*[st.sets(st.integers(1, n)).map(lambda s, n=n: sorted(s | {n}))] * 2)))
def test_terminals_are_components(sides):
    a, b = (np.array(s) for s in sides)
    spans = [(0 if k == 0 else s[k - 1], e) for s in sides for k, e in enumerate(s)]
    root = list(range(len(spans)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(a)):
        for j in range(len(a), len(spans)):
            if spans[i][0] < spans[j][1] and spans[j][0] < spans[i][1]:
                root[find(i)] = find(j)
    last = ta.terminals(ta.Segments(a, b))
    for i in range(len(spans)):
        for j in range(len(spans)):
            assert (last[i] == last[j]) == (find(i) == find(j))
    assert all(spans[t][1] == max(spans[i][1] for i in range(len(spans)) if find(i) == find(t)) for t in last)
