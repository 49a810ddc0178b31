"""Ids equal to those of the tokenizers library over whole texts, whatever the texts hold."""

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import token_files
from palimpsest.llm.common import new_dir
from palimpsest.llm.token_files import Encoder, default_tokenizer

MARKS = list("“”„»«…–—°™€¡¿·☃") + ["–-", "😀", "👩‍💻", "。", "！", "、", "「", "́", "̈", "é", "İ", "ß", "ſ", "ǅ", "Σ", "ς", "Ж", "ñ", "你好", "क़", "가", "각", "²", "½", "Ⅷ", "\x00", "\x1c", "​"]
PUNCTUATION = list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") + ["'s", "'t", "'re", "'LL", "...", "**", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "</w>", "|>"]
GAPS = [" ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x85", "\xa0", " ", "　"]
LETTERS = ["a", "A", "the", "The", "word", "ÉTÉ", "straße", "7", "2024", "x1", "don't", "we've", "ÀÖØöøɏ", "ªº"]


def texts_of(seed, n):
    rng = random.Random(seed)
    kinds = [MARKS, PUNCTUATION, GAPS, LETTERS, LETTERS]
    return ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(12))) for _ in range(n)]


def encoded(enc, texts, step=500):
    got = []
    for at in range(0, len(texts), step):
        for ids, n in enc.ids(pa.array(texts[at : at + step], pa.string())):
            ends = np.cumsum(n)
            assert ends[-1] == len(ids)
            got += [x.tolist() for x in np.split(ids, ends[:-1])]
    return got


@pytest.mark.parametrize("words", [token_files.WORDS, 50])
def test_any_text(words, monkeypatch):
    monkeypatch.setattr(token_files, "WORDS", words)
    enc = Encoder(default_tokenizer())
    assert enc.by_word
    fixed = ["", " ", "He said “yes”.", "wow😀!", "(“a”)", "end…)", "„nein“, sagte", "10€,", "5°.", "x™.", "–-", "»,", "你好。!", "a<|ENDOFTEXT|>b", "don't's ''s 'sx", "≠", "x≠.", "À.", "́a"]
    for texts in (fixed, texts_of(1, 20_000)):
        want = [x.ids for x in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert encoded(enc, texts) == want


def test_every_letter_that_is_cut():
    enc = Encoder(default_tokenizer())
    texts = [w + tail for i in range(0x300) for w in (chr(i), f"a{chr(i)}b", f"{chr(i)}Z") for tail in ("", ".", "'", "'s", ")”.")]
    assert encoded(enc, texts) == [x.ids for x in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_long_texts_are_cut_at_gaps(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 64)
    enc = Encoder(default_tokenizer())
    texts = ["short one", "word, “other” " * 40, "x" * 500, None, "é" * 90 + " it's " * 60, "z"]
    assert encoded(enc, texts) == [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("change", [{"normalizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}, {"added": "two words"}, {"added": ".."}])
def test_other_tokenizers_get_whole_texts(tmp_path, change):
    told = json.load(open(default_tokenizer()))
    if "added" in change:
        told["added_tokens"][0]["content"] = change["added"]
    else:
        told |= change
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told))
    enc = Encoder(str(path))
    assert not enc.by_word
    texts = [*texts_of(2, 500), "two words. and two words..", None]
    assert encoded(enc, texts) == [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_equal_ids_are_in_one_order(spark):
    rows = [(i % 3, f"text {j}") for i in range(60) for j in range(2)] + [(None, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("start", F.lit("clash"))
    seen = []
    for n in (2, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            manifest = token_files.write_token_files(docs, default_tokenizer(), new_dir(spark, "ties"))
            seen.append(token_files.read_token_files(manifest).orderBy("start").collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert seen[0] == seen[1]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    enc = token_files.encoder(default_tokenizer())
    crc = [zlib.crc32(np.array([*enc.tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for _, t in want]
    assert [(r["doc_id"], r["ids_crc32"]) for r in seen[0]] == [(r[0], c) for r, c in zip(want, crc, strict=True)]
