"""Aligned tokens against the definition by common ends, and the corpus counts against a plain count."""

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from buyerlens.llm import alignment
from buyerlens.llm.base import table
from buyerlens.llm.bytebpe import byte_chars
from buyerlens.llm.catalog import QUERIES, tokenizer_path, tokenizer_pattern

SF = "/root/testdata/sf0.001"
PATHS = ("byte_bpe_50k.json", "piece_bpe_32k.model")
ARGS = (tokenizer_path(PATHS[0]), tokenizer_pattern(), tokenizer_path(PATHS[1]))


def brute_groups(a, b):
    """Groups by common ends: ((i, k), (j, m)) from the sets of ends alone."""
    out, i, j = [], 0, 0
    for end in sorted(set(a) & set(b)):
        k, m = a.index(end) + 1, b.index(end) + 1
        out.append((i, k, j, m))
        i, j = k, m
    return out


def lengths(ends):
    return bytes(y - x for x, y in zip([0, *ends], ends))


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 120)), st.sets(st.integers(1, 120)), st.booleans())
def test_runs_are_the_groups_between_common_ends(a, b, alike):
    a, b = sorted(a | {121}), sorted((a ^ {x for x in b if x % 9 == 0} if alike else b) | {121})
    got, links, inner, by_a, n = [], set(), [], [], 0
    for (i, k, j, m), steps in alignment.runs(lengths(a), lengths(b)):
        if steps is None:
            assert k - i == m - j
            got += [(i + s, i + s + 1, j + s, j + s + 1) for s in range(k - i)]
            n += k - i
        else:
            got.append((i, k, j, m))
            inner += range(n + 1, n + 1 + len(steps))
            by_a += steps
            n += 1 + len(steps)
    links = list(zip(*(x.tolist() for x in alignment.links(n, inner, by_a))))
    assert len(links) == len(set(links))
    assert got == brute_groups(a, b)
    starts = [[0, *x[:-1]] for x in (a, b)]
    assert set(links) == {(x, y) for x in range(len(a)) for y in range(len(b)) if max(starts[0][x], starts[1][y]) < min(a[x], b[y])}


def test_long_stretches_and_no_tokens():
    a = [1] * 5000
    assert list(alignment.runs(a, a)) == [((0, 5000, 0, 5000), None)]
    assert list(alignment.runs([], [])) == []
    b = [1] * 2499 + [2] + [1] * 2499
    assert list(alignment.runs(a, b)) == [((0, 2499, 0, 2499), None), ((2499, 2501, 2499, 2500), [True]),
                                          ((2501, 5000, 2500, 4999), None)]


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(ARGS[0])
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=ARGS[2])
    back = {c: i for i, c in enumerate(byte_chars())}

    def tokens(text):
        text = text or ""
        a = tok.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        a_bytes = [bytes(back[c] for c in tok.id_to_token(x)) for x in a]
        b_bytes = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x) else sp.id_to_piece(x).replace("▁", " ").encode()
                   for x in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return [], [], [], []
        ends = [[sum(map(len, x[:i + 1])) for i in range(len(x))] for x in (a_bytes, b_bytes)]
        return a, b, *ends

    return tokens


def brute(texts, tokens):
    rows, count = [], Counter()
    for t in texts:
        a, b, ea, eb = tokens(t)
        sa, sb = [0, *ea[:-1]], [0, *eb[:-1]]
        links = [(a[x], b[y]) for x in range(len(a)) for y in range(len(b)) if max(sa[x], sb[y]) < min(ea[x], eb[y])]
        count.update(links)
        groups = brute_groups(ea, eb)
        text = ";".join(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])) for i, k, j, m in groups)
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted((na, nb, ng, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), sha)
                  for na, nb, ng, links, sha in rows)


ODD = [None, "", " ", "  two  spaces ", "a", "The end.\nNew line\ttab", "naïve Zürich 東京 🙂👩‍👩‍👧", "<|endoftext|> <s> </s> <unk> <0x41>",
       "▁ mark", "\x00\x01", "ﬁ ligature ½", "x" * 400, "é", "same same same", "same same same", "　wide", " lead", "trail "]


def digests(spark, texts, p=alignment.AlignParams()):
    docs = spark.createDataFrame([(i if i % 5 else None, t, "x", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, block string, pair long")
    return alignment.digests(docs, *ARGS, p)


@pytest.mark.parametrize("p", [alignment.AlignParams(), alignment.AlignParams(block_links=7), alignment.AlignParams(block_docs=2)])
def test_odd_texts_equal_brute_force(spark, plain, p):
    got = sorted(tuple(r)[1:] for r in digests(spark, ODD, p).collect())
    assert got == brute(ODD, plain)


def test_rank_encoder_equals_the_library(plain):
    from buyerlens.llm.bytebpe import rank_encoder

    tok = Tokenizer.from_file(ARGS[0])
    tok.encode_special_tokens = True
    enc = rank_encoder(*ARGS[:2])
    for t in [x or "" for x in ODD] + ["z" * 5000 + " end", " " * 4000 + "x", "12345678 " * 30, "\r\n\t\u2028 a\u0301"]:
        assert enc.encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text_is_encoded_as_by_the_libraries(plain, text):
    al = alignment.aligner(*ARGS)
    ((a, b),) = al.encode([text])
    assert (a.tolist(), b.tolist()) == plain(text)[:2]


def test_empty_table(spark):
    assert digests(spark, ["a"]).limit(0).count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.digests(docs, *ARGS).count() == 0
    assert alignment.alignments(docs, *ARGS).count() == 0


def test_very_long_text(spark):
    word = "Lorem ipsum dolor sit amet, consectetur. "
    r = digests(spark, [word * 20_000, word]).collect()
    long_, short = sorted(r, key=lambda x: -x.n_a)
    assert long_.n_links >= 19_000 * short.n_links and long_.n_groups > 19_000 * (short.n_groups - 1)


def test_given_documents(spark, plain):
    docs = table(spark, SF, "documents").where("length(text) < 1500")
    texts = [r.text for r in docs.select("text").collect()]
    got = sorted(tuple(r)[1:] for r in alignment.digests(docs, *ARGS).collect())
    assert len(texts) > 20 and got == brute(texts, plain)


def test_query_rows_and_spans(spark):
    rows = QUERIES["op12_token_alignment"](spark, SF)
    n = table(spark, SF, "documents").count()
    assert rows.count() == rows.select("doc_id").distinct().count() == n
    one = spark.createDataFrame([(1, "The Straßenbahn stopped.")], "doc_id long, text string")
    spans = alignment.alignments(one, *ARGS).orderBy("start").collect()
    assert [s.start for s in spans] == [0, *[s.end for s in spans[:-1]]] and spans[-1].end == len(" The Straßenbahn stopped.".encode())


def test_long_runs_are_told():
    from buyerlens.llm.bytebpe import rank_encoder

    enc = rank_encoder(*ARGS[:2])
    n = enc.RUN
    assert all(enc._long(t) for t in ("z" * n, "a " + "z" * n + " b", " " * n, "a" + "\n" * n + "b", "a " * 50 + " \t" * n))
    assert not any(enc._long(t) for t in ("", "a " * 5000, "z" * (n - 1), " " * (n - 3)))
