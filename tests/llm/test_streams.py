"""Token streams, repair of conversations and hard negatives against brute force, with odd, empty and clashing tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowtrail.llm import conversations, hard_negatives, queries, rans, repair, token_stream
from rowtrail.session import run_folder
from tests.compare import connect

SF_DIR = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SPACES = " \t\n\x0b\x0c\r"


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


# -- operator 11 ------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


@pytest.mark.parametrize("n", [0, 1, rans.LANES - 1, rans.LANES, rans.LANES + 1, 70_000, rans.BLOCK_SYMBOLS])
def test_blocks_decode_to_what_was_encoded(n):
    symbols = np.random.default_rng(n).zipf(1.3, n) % 40_000
    table = rans.Table.of_counts({int(s): int(c) for s, c in zip(*np.unique(symbols, return_counts=True), strict=True)})
    assert not n or table.frequencies.sum() == 1 << table.bits
    block = rans.encode(symbols, table)
    assert (rans.decode(block, table) == symbols).all()
    for first, last in ((0, 1), (n // 3, n // 2), (n - 1, n), (n // 2, n // 2)):
        assert (rans.decode(block, table, max(0, first), last) == symbols[max(0, first) : last]).all()


def test_blocks_come_near_the_entropy():
    symbols = np.random.default_rng(3).zipf(1.2, rans.BLOCK_SYMBOLS) % 30_000
    seen = np.unique(symbols, return_counts=True)
    share = seen[1] / len(symbols)
    table = rans.Table.of_counts(dict(zip(map(int, seen[0]), map(int, seen[1]), strict=True)))
    assert len(rans.encode(symbols, table)) * 8 < 1.03 * len(symbols) * -(share * np.log2(share)).sum()


def test_a_damaged_block_is_refused():
    symbols = np.arange(1000) % 7
    table, other = (rans.Table.of_counts(dict.fromkeys(range(7), k + 1) | {0: 99 * k + 1}) for k in range(2))
    block = rans.encode(symbols, table)
    for broken in (block[:-9], block[:50] + bytes([block[50] ^ 1]) + block[51:], b"", block + b"x"):
        with pytest.raises(rans.DamagedBlock):
            rans.decode(broken, table)
    with pytest.raises(rans.DamagedBlock):
        rans.decode(block, other)


def test_tables_of_rare_and_single_symbols():
    assert rans.Table.of_counts({5: 10}).frequencies.tolist() == [1 << 16]
    skewed = rans.Table.of_counts({0: 10**12} | dict.fromkeys(range(1, 3000), 1))
    assert skewed.frequencies.min() == 1 and skewed.frequencies.sum() == 1 << skewed.bits


def test_shifted_crc_joins_parts():
    for a, b in ((b"", b"x"), (b"abc", b""), (b"some bytes", b"\x00" * 1000), (b"p" * 77, b"q" * 4099)):
        assert token_stream.crc_shifted(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


def plain_stream(rows, tokenizer):
    """(doc_id, start, n_tokens, crc) of the rows in order."""
    out, start = Counter(), 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out[doc_id, start, len(ids), crc(ids)] += 1
        start += len(ids)
    return out


LONG = "a Very long text, été of Words and\x1csigns " * 30_000
TEXTS = [(3, None), (1, ""), (2, LONG), (None, "no id"), (None, "no id"), (9, "<|endoftext|> I'll don't <|startoftext|>"), (9, "<|endoftext|> I'll don't <|startoftext|>"), (-4, " \n"),
         (5, "ΌΣΟΣ İstanbul ﬁn 日本語 😀 12345"), (6, "x"), (7, LONG[:-9])]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def written(spark, frame):
    path = run_folder(spark, "test-stream")
    token_stream.write_stream(spark, frame, VOCABULARY, path)
    return path


def test_stream_is_read_back_from_its_files(spark, texts, tokenizer):
    ordered = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    for frame, rows in ((texts, ordered), (texts.withColumns({c: F.lit(1) for c in ("shard", "start", "tie", "row", "tokens", "first")}), ordered), (texts.limit(0), [])):
        found = token_stream.document_digests(spark, written(spark, frame)).collect()
        assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == plain_stream(rows, tokenizer)


def test_any_window_is_read_from_a_checkpoint(spark, texts, tokenizer, monkeypatch):
    monkeypatch.setattr(rans, "CHECKPOINT_STEPS", 64)
    monkeypatch.setattr(rans, "BLOCK_SYMBOLS", 1 << 18)
    path = written(spark, texts)
    every = [i for _, text in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)) for i in tokenizer.encode(text or "", add_special_tokens=False).ids + [1]]
    assert len(every) > 2 * rans.BLOCK_SYMBOLS
    for first, last in ((0, 5), (rans.BLOCK_SYMBOLS - 3, rans.BLOCK_SYMBOLS + 70_000), (len(every) - 4, len(every) + 10)):
        parts = token_stream.read_window(spark, path, first, last).orderBy("start").collect()
        assert [i for p in parts for i in p.ids] == every[first:last] and parts[0].start == first


def test_pieces_equal_the_tokenizer(tokenizer):
    draw = random.Random(4)
    parts = ["a", "B", "s", "t", "re", "ve", "ll", "m", "d", "'", "'", "'s", "'ll", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "1", "23", "!", "..", "_", "-", "<|endoftext|>", "\x00"]
    parts += ["é", "É", "ß", "İ", "Σ", "日", "😀", "e\u0301", "\u0301", "\u212a", "ﬁ", "×", "÷", "ñ", "ŉ", "ı", "Ǆ", "ɐ", "ʰ", "ª", "İ!", "\u2003"]
    pieces = token_stream.Pieces(tokenizer.to_str())
    for _ in range(500):
        texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(draw.randint(1, 20))]
        column = pa.array([t.encode() if t or draw.random() < 0.5 else None for t in texts], pa.binary())
        first = draw.randint(0, len(texts) - 1)
        ids, counts = pieces.encode(column[first:], 1)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts[first:]]


def test_remembered_pieces_are_forgotten_in_turn(tokenizer, monkeypatch):
    monkeypatch.setattr(token_stream, "MEMORY", 5)
    pieces = token_stream.Pieces(tokenizer.to_str())
    for k in range(20):
        texts = [f"word{k} of Many, and a few é{k % 3} more {k}"]
        assert pieces.encode(pa.array([texts[0].encode()]), 1)[0].tolist() == tokenizer.encode(texts[0], add_special_tokens=False).ids + [1]
    assert len(pieces.recent) + len(pieces.older) < 40


def test_token_stream_query_equals_the_library(spark, tokenizer):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    found = queries.op11_token_stream(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == plain_stream(rows, tokenizer)


# -- operator 12 ------------------------------------------------------------------------------------------------------

FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}


def exhaustive(rows):
    """The least (cost, audit) over all sequences of edits, by trying them."""
    best = None

    def go(i, last, cost, audit, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and last in ("", "a") and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if inserted < 3:
            for c in set(FOLLOWS[last]) & set("ua"):
                go(i, c, cost + 3, audit + "I", inserted + 1)
        if i < len(rows):
            role, fault = rows[i]
            more = 3 if fault == "truncated" else 0
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in FOLLOWS[last]:
                    go(i + 1, role[:1], cost + more, audit + "K", 0)
                for c in set(FOLLOWS[last]) & set("ua"):
                    go(i + 1, c, cost + 3 + more, audit + "R", 0)
            go(i + 1, last, cost + 4, audit + "D", 0)

    go(0, "", 0, "", 0)
    return best


def test_agenda_finds_the_lightest_repair_and_segments_compose():
    draw = random.Random(12)
    for _ in range(500):
        rows = [repair.Row(draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", " "]), f"t{i}", draw.choice([None, None, None, "blank", "duplicate", "truncated"])) for i in range(draw.randint(0, 6))]
        cost, audit = repair.lightest_repair(rows)
        assert (cost, audit) == exhaustive([(r.role, r.fault) for r in rows])
        left = list(repair.repaired(rows, repair.START, audit))
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in left))
        cuts = sorted(draw.randint(0, len(rows)) for _ in range(2))
        along = repair.Along()
        for part in (rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]):
            along.add(part, {q: repair.lightest_from(part, q) for q in repair.STATES})
        assert along.ended() == (cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())


def test_pops_come_in_order_of_weight():
    """A deduction of two antecedents, and a goal that is final before heavier items are."""
    def deduce(item, final):
        if item in ("a", "b") and {"a", "b"} <= final.keys():
            yield (final["a"][0] + final["b"][0] + 1, final["a"][1] + "x"), "ab"
        if item == "ab":
            yield (final["ab"][0], final["ab"][1] + "g"), "goal"

    final = repair.lightest([((2, "p"), "a"), ((0, ""), "b"), ((9, ""), "late"), ((3, "pz"), "ab")], deduce, ["goal"])
    assert final == {"a": (2, "p"), "b": (0, ""), "ab": (3, "px"), "goal": (3, "pxg")}


def plain_repairs(raw):
    """Damage and counts restated; the repair by exhaustion where a conversation is short, else by the one-piece agenda."""
    kept = defaultdict(list)
    for conv_id, turn, role, text in raw:
        spaced = [" " if v is None else str(v) for v in (conv_id, turn, role, text)]
        fate = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        rows = kept[conv_id]
        if fate:
            row = (turn, "user" if fate == 4 else spaced[2], "" if fate == 1 else re.sub("[.!?]", "", spaced[3]) if fate == 2 else spaced[3])
            rows += [row, row] if fate == 3 else [row]
    out = {}
    for conv_id, rows in kept.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, judged = set(), []
        for _, role, text in rows:
            body = text.strip(SPACES)
            judged.append((role, "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        turns = [t for t, *_ in rows if t is not None]
        items = [repair.Row(role, text, fault) for (_, role, text), (_, fault) in zip(rows, judged, strict=True)]
        cost, audit = exhaustive(judged) if len(rows) <= 8 else repair.lightest_repair(items)
        firsts = [role[:1] for role, _ in judged]
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[sum(f == fault for _, f in judged) for fault in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit, hashlib.sha256("\n".join(repair.repaired(items, 0, audit)).encode()).hexdigest())
    return out


def as_dict(frame):
    found = frame.collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[n] for n in names) for r in found}


CONVERSATIONS = (
    [(1, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(1, 40)] + [(2, t, None, None) for t in (1, 2, 3)] + [(None, t, "user", "No id!") for t in (None, None, 4, 9)]
    + [(3, None, "system", "S."), (3, 1, "user", "Q" * 300_000), (3, 2, "assistant", "A?"), (3, 2, "assistant", "A?"), (3, 2, "assistant", "A?")] + [(4, 0, "", ""), (5, -7, "tool", "x."), (5, 12, "Assistant", "y.")]
    + [(i, i % 7, "user", "Hi.") for i in range(10, 70)] + [(6, t % 5, "user" if t % 3 else "assistant", f"same {t % 4}.") for t in range(1, 5)])


def test_conversations_equal_plain_repairs(spark, monkeypatch):
    frame = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    want = plain_repairs(CONVERSATIONS)
    assert any(zlib.crc32(f"{i}:{i % 7}".encode()) % 20 == 0 for i in range(10, 70)), "a conversation without rows is among them"
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for rows in (512, 1, 3):
        monkeypatch.setattr(conversations, "SEGMENT_ROWS", rows)
        for given in (frame, frame.withColumns({c: F.lit(1) for c in ("tie", "row", "shard", "segment", "present", "cost", "whole")})):
            got = as_dict(conversations.repair_conversations(conversations.damaged(given)))
            assert got == want
    assert all(got[i] == empty for i in range(10, 70) if zlib.crc32(f"{i}:{i % 7}".encode()) % 20 == 0)
    assert conversations.repair_conversations(conversations.damaged(frame.limit(0))).collect() == []


def test_undamaged_conversations_stay_as_they_are(spark):
    frame = spark.createDataFrame([(1, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(1, 5)] + [(2, 1, "user", "q."), (2, 4, "user", "r")], "conv_id long, turn long, role string, text string")
    got = as_dict(conversations.repair_conversations(conversations.undamaged(frame)))
    assert got[1][:7] == (0, 0, 0, 0, 0, 0, "KKKK") and got[2][:6] == (2, 0, 0, 1, 1, 6) and got[2][6] == "KR"[:0] + exhaustive([("user", None), ("user", "truncated")])[1]


def test_conversation_query_equals_plain_repairs(spark):
    raw = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(queries.op12_conversation_repair(spark, SF_DIR)) == plain_repairs(raw)


# -- operator 13 ------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize(("width", "largest"), [(8, 3), (64, 256), (13, 100_000), (24, 1 << 22), (0, 1)])
def test_table_lookups_are_inner_products(width, largest):
    draw = np.random.default_rng(width)
    a, c = (draw.integers(-largest, largest + 1, (n, width)) for n in (7, 300))
    wide = [hard_negatives._matrix([row.tolist() for row in m]) for m in (a, c)]
    got = hard_negatives.scores(hard_negatives.planes(wide[1]), hard_negatives.subset_sums(wide[0]))
    assert (got == c @ a.T).all()


def test_best_rows_by_score_then_id():
    ranked = np.array([[5, hard_negatives._NONE], [7, -3], [5, -3], [7, hard_negatives._NONE]])
    score, ids = hard_negatives._best(ranked.copy(), np.array([10, 20, 30, 40]), 3)
    order = np.lexsort((ids[0], -score[0]))
    assert ids[0][order].tolist() == [20, 40, 10] and sorted(ids[1][score[1] != hard_negatives._NONE].tolist()) == [20, 30]
    large = ranked * (1 << 50)
    large[ranked == hard_negatives._NONE] = hard_negatives._NONE
    again, same = hard_negatives._best(large * 1, np.array([10, 20, 30, 40]), 3)
    assert set(same[0].tolist()) == {20, 40, 10}


def plain_negatives(rows):
    """Every score of every anchor, in order. rows: (vec_id, label, vector) that take part."""
    rows = sorted(set(rows))
    out = Counter()
    for anchor in rows:
        if anchor[0] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(anchor[2], row[2])), row[0], row[1]) for row in rows if row[0] != anchor[0])
        for p, pid, _ in [s for s in scored if s[2] == anchor[1]][:5]:
            band = [(s, i) for s, i, label in scored if label != anchor[1] and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out.update((anchor[0], pid, k + 1, i, -p, -s) for k, (s, i) in enumerate(band))
    return out


def taking_part(raw):
    for vec_id, label, vector in raw:
        if None not in (vec_id, label, vector) and all(x is not None and np.isfinite(x) for x in vector):
            yield vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in vector)


def mined(frame):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(frame, moved)
    return hard_negatives.mine(rows, rows.filter("vec_id % 100 = 0"))


def test_negatives_equal_all_scores(spark, monkeypatch):
    draw = random.Random(13)
    raw = [(i, draw.randint(0, 3), [draw.choice([-0.5, 0.0, 0.25, 0.5, 0.123]) for _ in range(draw.choice([11, 11, 11, 5]))]) for i in range(-300, 300)]
    raw += [(100, 1, raw[400][2]), (900, 7, [1.0] * 11), (901, 7, []), (902, None, [1.0]), (903, 1, None), (None, 1, [1.0]), (904, 1, [float("nan"), 1.0]), (905, 1, [float("inf")]), (906, 1, [None, 1.0])]
    raw += [raw[0]] * 30 + [(1000, 2, [0.5] * 11)] * 40 + [(1100, 9, [-1.0, 2.0])]
    frame = spark.createDataFrame(raw, "vec_id long, label int, embedding array<float>")
    want = plain_negatives(taking_part(raw))
    assert len(want) > 100
    for size in (2048, 7):
        monkeypatch.setattr(hard_negatives, "CANDIDATES", size)
        monkeypatch.setattr(hard_negatives, "ANCHORS", size // 3 or 1)
        for given in (frame, frame.withColumns({c: F.lit(1) for c in ("vector", "block", "lane", "score", "anchors")})):
            got = mined(given)
            assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            assert Counter(map(tuple, got.collect())) == want
    assert mined(frame.limit(0)).collect() == []


def test_kept_rows_are_sent_on_when_there_are_many(spark, monkeypatch):
    for name, value in (("KEPT_BLOCKS", 2), ("KEPT_TABLES", 1), ("ANCHORS", 1), ("CANDIDATES", 50)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    want = plain_negatives(taking_part(tuple(r) for r in rows.select("vec_id", "label", "embedding").collect()))
    assert Counter(map(tuple, queries.op13_hard_negatives(spark, SF_DIR).collect())) == want


def test_anchors_are_not_copied_and_not_broadcast(spark):
    raw = [(i, i % 3, [float(i % 5), float(i % 7), 1.0]) for i in range(400)]
    found = mined(spark.createDataFrame(raw, "vec_id long, label int, embedding array<float>"))
    assert Counter(map(tuple, found.collect())) == plain_negatives(taking_part(raw))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "explode(sequence" not in plan


def test_large_components_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        mined(spark.createDataFrame([(100, 1, [1e30])], "vec_id long, label int, embedding array<float>")).collect()


def test_negatives_equal_their_sql(spark):
    want = connect(SF_DIR).execute(queries.ORACLES["op13_hard_negatives"]).fetchall()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, queries.op13_hard_negatives(spark, SF_DIR).select(*names).collect())) == Counter(want) and want
