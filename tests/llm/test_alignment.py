"""The alignment of two tokenizers against whole texts through their libraries."""

import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newscorpus.llm import alignment, queries

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = dict(zip(map(chr, plain), plain))
    byte |= {chr(256 + k): v for k, v in enumerate(v for v in range(256) if v not in plain)}

    def tokens(text):
        in_a = a.encode(" " + text, add_special_tokens=False)
        in_b = b.encode(text)
        pieces = [b.id_to_piece(i) for i in in_b]
        return (
            [(i, bytes(byte[c] for c in t)) for i, t in zip(in_a.ids, in_a.tokens)],
            [
                (i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
                for i, p in zip(in_b, pieces)
            ],
        )

    return tokens


def by_hand(texts, tokens):
    """What each text should give, byte ranges compared one by one."""
    links, groups, sizes = [], [], []
    for text in texts:
        a, b = tokens(text) if text else ([], [])
        if not text or any(b"".join(t for _, t in side) != (" " + text).encode() for side in (a, b)):
            a, b = [], []
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        j0, found = 0, []
        for i, low, high in spans[0]:
            while j0 < len(b) and spans[1][j0][2] <= low:
                j0 += 1
            j = j0
            while j < len(b) and spans[1][j][1] < high:
                found.append((i, spans[1][j][0]))
                j += 1
        ends = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
        parts, low = [], 0
        for end in ends:
            parts.append("|".join(",".join(str(i) for i, _, e in s if low < e <= end) for s in spans))
            low = end
        links.append(found)
        groups.append(";".join(parts))
        sizes.append((len(a), len(b), len(ends)))
    count = Counter(p for found in links for p in found)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (*size, len(found), sum(count[p] == most[p[1]] for p in found), sum(count[p] for p in found), own)
        for size, found, own in zip(sizes, links, groups)
    ]


TEXTS = [
    None, "", " ", "  two  spaces ", "The quick brown fox's tail, won't they?", "a<|endoftext|>b <s> </s> <unk> <0x41>",
    "Größe señor naïve ﬁn ① é", "日本語のテキスト と 中文", "tab\tand\nline \n ends\r\n", "▁ marked ▁text", "emoji 👩‍👩‍👧 \U0001f600x",
    "x y   z​w \u0085 v\x1cq \x0b", "1234567 3.14 $%^ &*()", "null\x00byte", "repeat repeat repeat repeat", "é combining",
    "'s 'tis don't 'S", "a" * 3000, "word " * 2000, "　full width　", "repeat repeat repeat repeat",
]


def rows_of(df):
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return [(r["id"], *(r[c] for c in columns)) for r in df.collect()]


@pytest.mark.parametrize("unit, held, run", [(1 << 22, 100_000, 1 << 18), (200, 7, 50)])
def test_alignment(spark, monkeypatch, libraries, unit, held, run):
    monkeypatch.setattr(alignment, "UNIT_CHARS", unit)
    monkeypatch.setattr(alignment, "HELD", held)
    monkeypatch.setattr(alignment, "RUN_CHARS", run)
    rng = random.Random(5)
    alphabet = list("abcdeéß ü  \n\t.,'12#日▁") + [" the", " of", "tion", " Über"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    rows = [*enumerate(texts), (None, "a NULL id"), (3, texts[4]), (3, texts[4])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    df = df.withColumns({c: F.lit("clash") for c in ("id", "unit", "a", "b", "n", "groups", "marks", "_row", "ids")})
    got = rows_of(alignment.align(df, A, B))
    want = [(key, *w) for (key, _), w in zip(rows, by_hand([t for _, t in rows], libraries))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align(df, A, B).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert sorted(rows_of(alignment.align(only, A, B))) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]


def test_very_long_text(libraries):
    """Tokens of the parts are those of the whole."""
    rng = random.Random(7)
    words = ["alpha", "Beta's", "γάμμα", "x1", "日本", "\n\n", "", "  ", "...", "<s>"]
    text = " ".join(rng.choice(words) for _ in range(60_000))
    (a, b), = alignment.Pair(A, B).tokens([text])
    want = libraries(text)
    assert [list(memoryview(x).cast("i")) for x in (a, b)] == [[i for i, _ in side] for side in want]


def test_query_without_tokens(spark, tmp_path):
    spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = {r["doc_id"]: r for r in queries.op11_alignment(spark, str(tmp_path)).collect()}
    assert found[2]["groups_sha256"] == "" and len(found[1]["groups_sha256"]) == 64
    assert not spark.sql("SHOW TABLES").where("tableName LIKE 'units_%'").count()


def test_a_unit_looks_into_a_chunk_once(monkeypatch):
    """And the first chunks, which mostly recur, stay known."""
    learnt, looked = [], []
    learn, windows = alignment.Pair._learn, alignment.Unit._windows
    monkeypatch.setattr(alignment, "HELD", 40)
    monkeypatch.setattr(alignment.Pair, "_learn", lambda self, new: learnt.extend(new) or learn(self, new))
    monkeypatch.setattr(alignment.Unit, "_windows", lambda self, t: looked.append(len(t)) or windows(self, t))
    pair, rows = alignment.Pair(A, B), []
    for k in range(8):
        unit = alignment.Unit(pair)
        unit.add([1, 2], ["the news of the day", ""])
        unit.add([3, 4], ["news of the day, the news " + " ".join(f"x{k}y{i}" for i in range(12)), "the day"])
        rows.append(unit.row(k).to_pylist()[0])
    assert looked == [4, 13] * 8  # distinct chunks, not all of them
    assert all(learnt.count(c) == 1 for c in ("the", "news", "of", "day", "day,"))
    assert {tuple(r["n_windows"]) for r in rows} == {(5, 0, 18, 2)}
