import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import prose, table
from waybill.llm import alignment
from waybill.llm.queries import TOKENIZERS

A_PATH, B_PATH = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def plain_tokens(text, both):
    """Ids with end offsets of both sides, from whole texts; None if the bytes are not those of space + text."""
    if not text:
        return None
    a, b = both
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    letters = alignment.byte_letters()
    of_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    of_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
    raw = (" " + text).encode()
    if b"".join(of_a) != raw or b"".join(of_b) != raw:
        return None
    return [list(zip(ids, np.cumsum([len(t) for t in tokens]).tolist())) for ids, tokens in ((ids_a, of_a), (ids_b, of_b))]


def plain_report(rows, both):
    parts, counts = [], Counter()
    for i, text in rows:
        found = plain_tokens(text, both)
        if not found:
            parts.append((i, 0, 0, [], ""))
            continue
        a, b = found
        links = [(x, y) for x, e in a for y, f in b if e == f] if len(a) < 300 else [(x, dict((f, y) for y, f in b)[e]) for x, e in a if e in {f for _, f in b}]
        cuts = sorted({e for _, e in a} & {f for _, f in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append(",".join(str(x) for x, e in a if low < e <= cut) + "|" + ",".join(str(y) for y, f in b if low < f <= cut))
            low = cut
        counts.update(links)
        parts.append((i, len(a), len(b), links, ";".join(groups)))
    top = Counter()
    for (x, y), n in counts.items():
        top[y] = max(top[y], n)
    return Counter(
        (i, n_a, n_b, text.count(";") + 1 if text else 0, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else "")
        for i, n_a, n_b, links, text in parts
    )


EDGES = [
    (1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "a▁b"), (6, "x <|endoftext|> y </s> <0x41> <unk> z"), (7, "café naïve über жук"),
    (8, "  nbsp  x"), (9, "あい 日本語 \U0001f600\U0001f600 ok"), (10, "a\tb\nc\r\n d"), (11, "it's we'll I'M 'tis"), (12, "\x00 \x01\x7f x"), (13, "same"), (13, "same"), (None, "null id"),
    (14, "é ﬁ   em   ls \u0085 nel"), (15, "1234567 3.14159 ,,, ;;; ### a"), (16, "aaaa" * 40), (17, "<s>"), (18, "﻿bom x"),
]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_report_equals_the_plain_one(spark, both):
    rng = random.Random(4)
    alphabet = ["a", "b ", " ", "the ", "é", "ß ", "\n", "▁", " ", "Ж ", "€", "9", ".", "' s", "\U0001f600 "]
    rows = EDGES + [(100 + k, "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40)))) for k in range(200)] + [(400 + k, prose(k, 50)) for k in range(20)]
    docs = table(spark, rows).withColumn("pairs", F.lit("clash")).withColumn("times", F.lit(1)).withColumn("n_a", F.lit(2))
    found = alignment.alignment_report(docs, A_PATH, B_PATH).select(*COLUMNS).collect()
    assert Counter(map(tuple, found)) == plain_report(rows, both)


def test_units_do_not_change_tokens_of_given_texts(spark, folder, both):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = alignment.token_counts(spark.read.parquet(f"{folder}/documents.parquet"), A_PATH, B_PATH).collect()
    sizes = {r.doc_id: (r.n_a, r.n_b) for r in found}
    for i, text in rows:
        tokens = plain_tokens(text, both)
        assert sizes[i] == ((len(tokens[0]), len(tokens[1])) if tokens else (0, 0))


def test_long_texts_go_in_stretches(spark, both):
    rows = [(1, prose(1, 60_000)), (2, "x" * 50_000), (3, "short one")]
    found = {r.doc_id: r for r in alignment.alignment_report(table(spark, rows, 1), A_PATH, B_PATH).collect()}
    for i, text in rows:
        a, b = plain_tokens(text, both)
        common = {e for _, e in a} & {e for _, e in b}
        assert (found[i].n_a, found[i].n_b, found[i].n_links) == (len(a), len(b), len(common))


def test_kept_units_are_bounded():
    encoder = alignment.Encoder(alignment.byte_level(A_PATH), alignment.sentence_piece(B_PATH), most=100)
    for k in range(30):
        units = [f" unit{k % 7}{j}".encode() for j in range(9)] + [b" a\xe2\x96\x81b"]
        good, sides = encoder(units)
        assert good.tolist() == [True] * 9 + [False] and len(encoder.numbers) <= 30
        for (ids, sizes), vocabulary in zip(sides, encoder.sides):
            assert b"".join(vocabulary.bytes_of[i] for i in ids[: sizes[:9].sum()]) == b"".join(units[:9])


def test_lockstep_equals_a_merge_by_sets():
    rng = np.random.default_rng(2)
    for _ in range(50):
        total = int(rng.integers(1, 400))
        a, b = (np.union1d(rng.integers(1, total + 1, rng.integers(1, 200)), [total]) for _ in range(2))
        low = np.arange(0, total, 37)
        x, y = alignment.lockstep(a, b, low, np.minimum(low + 37, total))
        assert a[x].tolist() == b[y].tolist() == np.intersect1d(a, b).tolist()


def test_pairs_are_bounded_by_the_vocabularies():
    a, b = alignment.byte_level(A_PATH), alignment.sentence_piece(B_PATH)
    assert alignment.most_pairs([b"ab", b"b", b"c"], [b"b", b"xab", b"b"]) == 2 + 1 + 2 + 1
    assert alignment.most_pairs(a.bytes_of, b.bytes_of) < 1_000_000 and a.size * b.size < 2**31


def test_empty_table(spark):
    assert alignment.alignment_report(table(spark, []), A_PATH, B_PATH).count() == 0
