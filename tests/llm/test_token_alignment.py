import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lettersieve.llm import token_alignment as operator
from lettersieve.llm.bpe import byte_alphabet

ODD = [
    "  two  spaces \n\n\t x \n",
    " ",
    "\n",
    "a<|endoftext|>b <s> </s> <0x41> <unk>",
    "café über naïve é ​    x",
    "日本語の文 한국어 русский \U0001f600\U0001f468‍\U0001f469 ꟒",
    "with▁mark and ▁ more",
    "\x00\x01 \x1c\x7f\x85 end ",
    "trailing spaces   ",
    "x" * 3000 + " " + "ab" * 500,
    "word " * 3000,
]


def plain_groups(text, made, model):
    """Groups of a whole text by decoded bytes alone."""
    if not text:
        return None
    a = made.encode(" " + text, add_special_tokens=False).ids
    b = model.encode(text)
    alphabet = byte_alphabet()
    a_bytes = [bytes(alphabet[c] for c in made.id_to_token(i)) for i in a]
    b_bytes = []
    for i in b:
        piece = model.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None

    def ends(tokens):
        at = 0
        for t in tokens:
            at += len(t)
            yield at

    a_ends, b_ends = list(ends(a_bytes)), list(ends(b_bytes))
    groups, i, j = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        m = sum(e <= end for e in a_ends[i:i + 5000]) + i
        n = sum(e <= end for e in b_ends[j:j + 5000]) + j
        groups.append((a[i:m], b[j:n]))
        i, j = m, n
    return groups


def expected(rows):
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    all_groups = [plain_groups(t, made, model) for _, t in rows]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in all_groups]
    count = Counter(pair for own in links for pair in own)
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    for (doc_id, _), groups, own in zip(rows, all_groups, links, strict=True):
        if groups is None:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
            continue
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        yield (
            doc_id,
            sum(len(a) for a, _ in groups),
            sum(len(b) for _, b in groups),
            len(groups),
            sum(own.values()),
            sum(n for p, n in own.items() if count[p] == top[p[0]]),
            sum(n * count[p] for p, n in own.items()),
            hashlib.sha256(written.encode()).hexdigest(),
        )


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    found = operator.digest(docs)
    assert found.columns == ["doc_id", *operator._RESULTS]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected(rows), key=key)


def test_equals_brute_force(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet").filter(F.length("text") < 8000))


def test_odd_texts(spark, odd_docs):
    check(odd_docs.filter("text is null or length(text) < 10000"))
    check(spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string"))


def test_empty_table(spark, no_docs):
    assert operator.digest(no_docs).collect() == []


def test_clashing_columns(spark, odd_docs):
    docs = odd_docs.withColumns({n: F.lit(f"own {n}") for n in ("n_a", "block", "row", "links", "best", "a")})
    found = operator.align(docs)
    assert found.columns[: len(docs.columns)] == docs.columns and "_n_a" in found.columns
    assert {r["n_a"] for r in found.collect()} == {"own n_a"}
    assert found.count() == docs.count()


def test_every_block_size_gives_the_same(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    one = sorted(map(tuple, operator.align(docs, keep_text=False).collect()))
    assert sorted(map(tuple, operator.align(docs, keep_text=False, block_bytes=20_000).collect())) == one


def test_pair_counts(spark):
    docs = spark.createDataFrame([(1, "the cat"), (2, "the cat the cat"), (3, "the")], "doc_id bigint, text string")
    found = operator.pair_counts(docs).collect()
    assert sorted(r["n"] for r in found) == [2, 3] and all(r["best"] for r in found)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    alphabet = " \n\t'sdlmt▁Az09_-.é́日\U0001f600  "
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(200)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
