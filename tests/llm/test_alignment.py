"""Token alignment against plain tokenisation and merging, text by text."""

import bisect
import collections
import hashlib
import itertools

import pytest
import sentencepiece
from tokenizers import Tokenizer

from test_llm_operators import A_LONG, DOCS, clashing, odd_rows
from tidemark.llm import alignment

TEXTS = [
    None, "", " ", "plain words here", "\n\nlines \n and  spaces  ", "x\x00y\ttab", "é" * 60 + " ü\xa0ß", "<s> <|endoftext|> </s>", "it's 's ’s we'll",
    "日本語 のテキスト 🙂🙂", "a▁b", "ﬁne ½ ①", "w\x1c z\x85q", "\n", "12 345,678.90", "plain words here", "tail\n", "\tlead",
]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(f"{alignment.FOLDER}/{alignment.BYTE_BPE}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{alignment.FOLDER}/{alignment.PIECE_BPE}")


def plain_groups(models, text):
    """Groups as lists of ids, from whole-text tokenisation; none where the bytes differ."""
    a, b = models
    if not text:
        return []
    of = alignment.byte_level()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    if not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
        return []
    ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b))
    groups = collections.defaultdict(lambda: ([], []))
    common = sorted(set(ends_a) & set(ends_b))
    for side, ids, ends in ((0, ids_a, ends_a), (1, ids_b, ends_b)):
        for i, end in zip(ids, ends):
            groups[bisect.bisect_left(common, end)][side].append(i)
    return [groups[g] for g in range(len(common))]


def expected(models, rows):
    found = [plain_groups(models, text) for _, text in rows]
    pairs = [collections.Counter((x, y) for a, b in g for x in a for y in b) for g in found]
    count = collections.Counter(p for c in pairs for p in c)
    highest = collections.defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    for (doc_id, _), g, c in zip(rows, found, pairs):
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        yield (
            doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
            sum(n for p, n in c.items() if count[p] == highest[p[0]]), sum(n * count[p] for p, n in c.items()),
            hashlib.sha256(written.encode()).hexdigest() if g else "",
        )


@pytest.mark.parametrize("block_bytes", [40, alignment.BLOCK_BYTES])
def test_alignment_equals_plain_merging(spark, models, block_bytes):
    rows = [*enumerate(TEXTS), (3, "plain words here"), (None, "no id"), (99, A_LONG)]
    done = alignment.align_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), block_bytes=block_bytes).drop("groups")
    assert sorted(map(repr, map(tuple, done.collect()))) == sorted(map(repr, expected(models, rows)))


def test_written_groups(spark, models):
    row = alignment.align_tokens(spark.createDataFrame([(1, TEXTS[4])], "doc_id bigint, text string"), with_groups=True).first()
    want = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in plain_groups(models, TEXTS[4]))
    assert row["groups"] == want and row["groups_sha256"] == hashlib.sha256(want.encode()).hexdigest()


def test_odd_tables(spark):
    odd = spark.createDataFrame(odd_rows(), DOCS)
    rows = sorted(map(repr, alignment.align_digest(odd).collect()))
    assert len(rows) == len(odd_rows())
    clash = clashing(odd).selectExpr("*", "'x' AS block", "'x' AS a", "'x' AS groups", "'x' AS n_a")
    assert sorted(map(repr, alignment.align_digest(clash).collect())) == rows
    assert alignment.align_digest(odd.limit(0)).collect() == []
