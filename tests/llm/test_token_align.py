"""Cross-tokenizer alignment against whole-text encoding and a plain merge of the two token lists."""

import hashlib
import random
from collections import Counter

import pytest

from chunkwright.llm import token_align
from chunkwright.llm.token_align import FOLDER

A, B = f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model"
ODD = [
    None, "", " ", "  ", "x", "x ", " x", "a  b", "a\n b", "a \n b", "a\u00a0 b c", "tab\tone  two", "naïve café Straße", "日本語 の 文", "\u2581x word", "word \u2581 x", "<|endoftext|> and <s> </s>", "a\x00b c",
    "it's we'll they've I'm", "1234567 89", "🙂🙂 👩\u200d👩\u200d👧", "x" * 3000, "e\u0301 \u0301", "word\u3000word \u2009 thin", "\r\n line\r\n", "trailing   ", "!!! ??? ...", "a" + " " * 40 + "b", "ﬁ ligature", "\x1c x \x85 y",
]


@pytest.fixture(scope="module")
def models():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def expected(texts, models):
    t, p = models
    letters = token_align.byte_letters()
    bytes_a = {i: bytes(letters[c] for c in x) for x, i in t.get_vocab().items() if x != "<|endoftext|>"}
    bytes_b = token_align.Pieces(open(B, "rb").read()).bytes
    rows, pairs = [], Counter()
    for text in texts:
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = p.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a[i] for i in a) != whole or b"".join(bytes_b[i] for i in b) != whole:
            rows.append(None)
            continue
        spans = []
        for ids, of in ((a, bytes_a), (b, bytes_b)):
            at, got = 0, []
            for i in ids:
                got.append((at, at + len(of[i]), i))
                at += len(of[i])
            spans.append(got)
        ends = sorted({x[1] for x in spans[0]} & {x[1] for x in spans[1]})
        groups = []
        for lo, hi in zip([0, *ends], ends, strict=False):
            groups.append("|".join(",".join(str(i) for s, e, i in side if s >= lo and e <= hi) for side in spans))
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]] if len(a) * len(b) < 4e6 else None
        pairs.update(set(links))
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best: dict[int, int] = {}
    for (a, _), n in pairs.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((r[0], r[1], r[2], len(r[3]), sum(pairs[x] == best[x[0]] for x in r[3]), sum(pairs[x] for x in r[3]), hashlib.sha256(r[4].encode()).hexdigest()))
    return out, pairs, best


def texts_of(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß日 \n\t'0.") for _ in range(r.randint(1, 9))) for _ in range(60)] + ["the", "of", "and", "tion", "weather", "tokenization"]
    return [" ".join(r.choice(words) for _ in range(r.randint(1, 80))) for _ in range(n)]


def test_against_brute_force(spark, models):
    texts = ODD + texts_of(5, 40) + ODD[6:12]
    want, pairs, best = expected(texts, models)
    ids = [*range(len(texts) - 3), None, 7, 7]
    df = spark.createDataFrame([(i, t, "mine") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, pairs string")
    for size in (1, 400, 8 << 20):
        found, table = token_align.align(df.repartition(3), A, B, block_bytes=size, keep_groups=True)
        got = [tuple(r)[:-1] for r in found.collect()]
        assert Counter(got) == Counter((i, *w) for i, w in zip(ids, want, strict=True)), size
        assert {(r["a"], r["b"]): (r["n"], r["best"]) for r in table.collect()} == {k: (n, n == best[k[0]]) for k, n in pairs.items()}
        assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in found.collect() if r["groups_sha256"])


def test_given_documents(spark, small, models):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r["text"]) < 2500]
    want, _, _ = expected([r["text"] for r in short], models)
    found, _ = token_align.align(spark.createDataFrame(short, "doc_id long, text string"), A, B)
    got = {r["doc_id"]: tuple(r)[1:-1] for r in found.collect()}
    assert got == {r["doc_id"]: w for r, w in zip(short, want, strict=True)} and len(short) > 100


def test_empty_and_vocabulary_checks(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    found, table = token_align.align(none, A, B)
    assert found.count() == 0 == table.count() and found.schema["doc_id"].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        token_align.ByteLevel(open(f"{FOLDER}/word_bpe_49k.json", "rb").read())
