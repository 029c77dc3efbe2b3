import hashlib
import random

import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from lettersieve.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None,
    "",
    " ",
    "  two  spaces \n\n\t x \n",
    "it's we'll I'D 12ab ½ Ⅷ x² ____ --",
    "a<|endoftext|>b <|endoftext|><|endoftext|> <|endoftext",
    "café über naïve é ​ 　  x",
    "日本語の文 한국어 русский \U0001f600\U0001f468‍\U0001f469 \U00031350꟒",
    "\x00\x01\x1c\x1f\x7f\x85",
    "word " * 30_000 + "end",
]


def library():
    made = Tokenizer.from_file(PATH)
    made.no_padding()
    made.no_truncation()
    return made


def expected(rows):
    made = library()
    for doc_id, text in rows:
        ids = made.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        back = made.decode(ids, skip_special_tokens=False)
        yield doc_id, len(ids), sha(",".join(map(str, ids))), sha(back)


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, bpe.digest(docs).collect()), key=key) == sorted(expected(rows), key=key)


def test_equals_library(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_odd_texts(spark, odd_docs):
    check(odd_docs)
    check(spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string"))


def test_empty_table(spark, no_docs):
    assert bpe.digest(no_docs).collect() == []
    assert bpe.decode(bpe.encode(no_docs)).columns == [*no_docs.columns, "ids", "decoded"]


def test_clashing_columns(spark, odd_docs):
    docs = odd_docs.withColumns({n: F.lit(f"own {n}") for n in ("ids", "decoded", "block", "rows", "word")})
    back = bpe.decode(bpe.encode(docs), ids="_ids")
    assert back.columns == [*docs.columns, "_ids", "_decoded"]
    assert {r["ids"] for r in back.collect()} == {"own ids"}
    assert back.filter(F.col("_decoded") != F.coalesce("text", F.lit(""))).count() == 0
    assert back.count() == docs.count()


def test_every_block_size_gives_the_same(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    one = {r["doc_id"]: r["ids"] for r in bpe.encode(docs, keep_text=False).collect()}
    assert {r["doc_id"]: r["ids"] for r in bpe.encode(docs, block_bytes=5_000).collect()} == one


def test_each_distinct_word_once(spark):
    docs = spark.createDataFrame([(i, f"the cat {i % 7} the cat") for i in range(500)], "doc_id bigint, text string")
    table = {r["word"]: r["ids"] for r in bpe.word_table(docs).collect()}
    made = library()
    assert set(table) == {"the", " the", " cat", *[f" {i}" for i in range(7)]}
    assert all(made.encode(w, add_special_tokens=False).ids == ids for w, ids in table.items())


def test_decode_of_any_ids(spark):
    made, rng = library(), random.Random(5)
    rows = [[rng.randrange(50_257) for _ in range(rng.randrange(40))] for _ in range(200)]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)] + [(-1, None)], "n int, ids array<int>")
    found = {r["n"]: r["decoded"] for r in bpe.decode(frame).collect()}
    assert found.pop(-1) == ""
    assert found == {i: made.decode(r, skip_special_tokens=False) for i, r in enumerate(rows)}


def test_rule_and_library_split_alike():
    """Every character that the fast rule takes is split as the library splits it."""
    rule, plain = regex.compile(bpe.SPLIT), regex.compile(f"[{bpe._PLAIN}]")
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    for code in range(0x10000):
        if 0xD800 <= code < 0xE000 or not plain.match(chr(code)):
            continue
        c = chr(code)
        text = f"a{c}a 1{c}1  {c}!{c}"
        assert rule.findall(text) == [text[i:j] for _, (i, j) in split.pre_tokenize_str(text)], hex(code)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    alphabet = " \n\t'sdlmtrvAz09_-.é́日\U0001f600  "
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(300)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
