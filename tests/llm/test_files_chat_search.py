import hashlib
import random
import re
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edispark.llm import chat, token_files, topk

from .data import empty_documents, odd_documents

VOCAB = token_files.vocabulary_path("byte_bpe_50k.json")


def test_pieces_encode_like_the_library():
    e, plain = token_files.Encoder.of(VOCAB), Tokenizer.from_file(VOCAB)
    r = random.Random(3)
    bits = ["a", "The", "n't", "'s", "12", " ", "\n", "  ", "\t", chr(0xA0), "é", "!!", "%%%", "<|endoftext|>", "\r\n", "", "日本", "\x1c", chr(0x2003), "x1"]
    for _ in range(1500):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        got = array("I")
        got.frombytes(next(e.encode([text])))
        assert list(got) == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_added_tokens_have_the_ids_of_the_plain_call(spark, tmp_path):
    plain = Tokenizer.from_file(VOCAB)
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n b", "<|endoftext|", "\u00a0<|endoftext|> é"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [87, 220, 50256, 331]
    out = str(tmp_path / "tokens")
    token_files.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), out, VOCAB)
    rows = token_files.read_tokens(spark, out).collect()
    assert [list(r.ids) for r in sorted(rows, key=lambda r: r.doc_id)] == [[*ids, token_files.END] for ids in want]


def test_words_that_come_again_outlive_those_met_once(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_PIECES", 200)
    e, plain = token_files.Encoder(VOCAB), Tokenizer.from_file(VOCAB)
    merged, own = [], token_files.Encoder._merged
    monkeypatch.setattr(token_files.Encoder, "_merged", lambda self, part: merged.append(part) or own(self, part))
    list(e.encode(["start again"]))
    signs = ["", ".", ",", "!?", "###", "\n", "\n\n", "'s", "1", "ª", "è", "ßx", "漢"]
    for k in range(60):
        runs = f"start again, again. again {' '.join(f'w{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j)}{s}' for j, s in enumerate(signs))} again"
        texts = [runs, runs.replace("\n\n", "").replace("\n ", "\n"), " again", "again ", ""]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in e.encode(texts)] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
        assert len(e.after_blank) + len(e.older) <= 200 + 80
    # however often room is made, and whatever sign follows
    assert merged.count(" again") == 1


def test_new_pieces_of_many_texts_are_merged_together(monkeypatch):
    """Latin words, cut at blanks, line ends and signs behind letters, never go to the merge model one by one; those that come again do not go to it at all."""
    monkeypatch.setattr(token_files, "KEPT_PIECES", 600)
    e, plain = token_files.Encoder(VOCAB), Tokenizer.from_file(VOCAB)
    alone, together, own, all_own = [], [], token_files.Encoder._merged, getattr(token_files.Encoder, "_merged_all", None)
    monkeypatch.setattr(token_files.Encoder, "_merged", lambda self, part: alone.append(part) or own(self, part))
    monkeypatch.setattr(token_files.Encoder, "_merged_all", lambda self, parts: together.append(parts) or all_own(self, parts), raising=False)
    r = random.Random(8)
    for k in range(40):
        words = ["".join(r.choice("abcdefghéßøÀ") for _ in range(r.randint(6, 9))) for _ in range(100)]
        texts = [" ".join(w + r.choice(["", "\nagain", " again"]) for w in words[a : a + 20]) for a in range(0, 100, 20)]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in e.encode(texts)] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
        assert set(alone) <= {"\n"} and len(together) == k + 1
    assert sum(parts.count(" again") for parts in together) == 1
    bits = ["ab", "é", "×", "÷", "'", "'s", "don't", "x'll", ".", ",", "%%%", "$", "-", "_", "1", "漢", "ª", " ", " ", "\n", "ñ", "\x00", "\u0130", "\u0300"]
    for _ in range(400):
        texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(8)]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in e.encode(texts)] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)], texts


def test_other_vocabularies_encode_whole_texts():
    e = token_files.Encoder(token_files.vocabulary_path("word_bpe_49k.json"))
    got = array("I")
    got.frombytes(next(e.encode(["Hello  World"])))
    assert list(got) == e.tokenizer.encode("Hello  World", add_special_tokens=False).ids


def test_token_files(spark, tmp_path):
    """Rows as the files hold them, null ids and seven texts under one id among them, against the library and a running sum."""
    docs = odd_documents(spark).select("doc_id", "text")
    same = [(7, "word " * n) for n in (2, 15, 3, 17, 11, 5, 19)]
    docs = docs.union(spark.createDataFrame(same, docs.schema)).repartition(3)
    out = str(tmp_path / "tokens")
    token_files.write_tokens(docs, out, VOCAB)
    plain = Tokenizer.from_file(VOCAB)
    want = sorted(((r.doc_id, *plain.encode(r.text or "", add_special_tokens=False).ids, 2) for r in docs.collect()), key=repr)
    files = sorted(token_files.read_tokens(spark, out).collect(), key=lambda r: (r.part, r.place))
    assert sorted(((r.doc_id, *r.ids) for r in files), key=repr) == want
    assert [r.doc_id for r in files] == sorted((r.doc_id for r in files), key=lambda x: (x is not None, x))
    at, starts = 0, []
    for r in files:
        assert r.n_tokens == len(r.ids)
        starts.append((r.doc_id, at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())))
        at += len(r.ids)
    got = sorted((tuple(r) for r in token_files.index_of(spark, out).collect()), key=lambda r: r[1])
    assert got == starts
    one = token_files.read_tokens(spark, out).where("doc_id = 8")
    assert one.count() == 1 and "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,8)]" in one._jdf.queryExecution().toString()
    assert token_files.tokenized(empty_documents(spark), VOCAB).count() == 0


def test_bloom_filters_are_in_the_files(spark, tmp_path):
    out = str(tmp_path / "tokens")
    token_files.write_tokens(odd_documents(spark), out, VOCAB)
    files = [p for p in (tmp_path / "tokens").iterdir() if p.suffix == ".orc"]
    jvm = spark._jvm
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(str(files[0])), jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
    assert reader.getRowIndexStride() == 10000
    footer = str(reader.rows().readStripeFooter(reader.getStripes()[0]))
    assert "BLOOM_FILTER" in footer and "ROW_INDEX" in footer and "DIRECT_V2" in footer


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", "<|end|><\\|end|><\\\\|end|>", "<s><<SYS>>", "[\\INST]", "plain \\ text <| end"])
def test_escapes_go_back(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_random_escapes_go_back():
    r = random.Random(1)
    bits = [*chat.CONTROLS, "\\", "<", "|", "[", "INST]", "x", "end|>", "/"]
    for _ in range(3000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 8)))
        assert chat.unescape(chat.escape(t)) == t
        segment, spans, _ = chat.format_turn("assistant", [chat.Part("text", t)])
        assert chat.parse(segment) == [("assistant", t)] and chat.unescape(segment[spans[0][0] : spans[0][1]]) == t


def test_parts():
    parts = [chat.Part("text", "see"), chat.Part("image", uri="a.png", width=1024, height=512), chat.Part("audio", uri="b.wav", seconds=2), chat.Part("document", uri="c.pdf", pages=3), chat.Part("text", "end")]
    segment, spans, attached = chat.format_turn("assistant", parts)
    assert segment == "<|turn|>assistant<|text|>see<|image|><|audio|><|document|>end<|end|>"
    assert [(a["kind"], a["uri"], a["tokens"]) for a in attached] == [("image", "a.png", 85 + 2 * 170), ("audio", "b.wav", 50), ("document", "c.pdf", 3000)]
    assert all(segment[a["place"] :].startswith(f"<|{a['kind']}|>") for a in attached)
    assert [segment[a:b] for a, b in spans] == ["see", "end"] and chat.format_turn("user", parts)[1] == []


def test_parts_of_unknown_kinds_and_long_turns():
    parts = [chat.Part("video", uri="v.mp4", pages=2), chat.Part("note", text="a <|end|>"), chat.Part(None)]
    segment, spans, attached = chat.format_turn("assistant", parts)
    assert segment == "<|turn|>assistant<|text|><|document|>a <\\|end|><|document|><|end|>" and [(a["kind"], a["tokens"]) for a in attached] == [("video", 2000), (None, 1000)]
    text = "</s>[INST] ok [/INST] " * 100_000
    segment, spans, _ = chat.format_turn("assistant", [chat.Part("text", text)])
    assert chat.parse(segment) == [("assistant", text)] and chat.unescape(segment[spans[0][0] : spans[0][1]]) == text


def test_conversations(spark):
    rows = [(1, 2, "assistant", "b </s>"), (1, 1, "user", "a"), (1, 2, "assistant", "b </s>"), (2, None, None, None), (2, 0, "assistant", "ü"), (None, 1, "user", "x"), (3, 1, "", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("k", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.formatted_turns(df, chat.text_parts(F.col("text")))).collect()}
    order = {1: [("user", "a"), ("assistant", "b </s>"), ("assistant", "b </s>")], 2: [("", ""), ("assistant", "ü")], None: [("user", "x")], 3: [("", "")]}
    assert set(got) == set(order)
    for k, turns in order.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[k].n_turns == len(turns) and got[k].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert got[k].loss_chars == len(loss) and got[k].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[k].formatted_chars == sum(len(chat.format_turn(a, [chat.Part("text", b)])[0]) for a, b in turns)
    assert chat.read_back(chat.formatted_turns(df.where("false"), chat.text_parts(F.col("text")))).count() == 0


def best(rows, k):
    vec = {i: np.floor(256 * np.asarray(v, "f8")) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q in (i for i in vec if i % 50 == 0):
        scores = []
        for i, v in vec.items():
            if i != q:
                n = min(len(v), len(vec[q]))
                scores.append((-int(sum(int(a) * int(b) for a, b in zip(v[:n], vec[q][:n], strict=True))), i))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def test_top_k(spark, monkeypatch):
    for name, n in (("BLOCK", 8), ("RUN_BLOCKS", 3), ("RUN_SUMMARIES", 4), ("QUERY_GROUP", 2), ("PART_GROUPS", 2)):
        monkeypatch.setattr(topk, name, n)
    r = random.Random(2)
    rows = [(i, [round(r.gauss(0, 1), 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000, [1.0]), (1001, None), (1002, []), (1003, [None, 1.0]), (1004, [float("nan")] * 6), (1050, [float("inf")]), (1100, [0.0] * 6), (1101, rows[3][1]), (1150, [1e30, -1e30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("part", F.lit(1)).repartition(3)
    exact = [(i, [float(np.float32(x)) for x in v] if v and all(x is not None for x in v) else v) for i, v in rows]
    got = {tuple(x) for x in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    want = {(q, k, i, max(min(s, 2**63 - 1), -(2**63))) for q, k, i, s in best(exact, 5)}
    assert {x for x in got if x[0] != 1150} == {x for x in want if x[0] != 1150} and len(got) == len(want)
    few = topk.top_k(df.where("vec_id < 3"), F.col("vec_id") % 50 == 0).collect()
    assert len(few) == 2 and topk.top_k(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_most_blocks_are_left_out_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    r = random.Random(5)
    centres = [[r.gauss(0, 1) for _ in range(16)] for _ in range(40)]
    rows = [(i, [x + r.gauss(0, 0.02) for x in centres[i % 40]]) for i in range(2400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    counts = topk.BlockCounts()
    got = {tuple(x) for x in topk.top_k(df, F.col("vec_id") % 50 == 0, counts=counts).collect()}
    assert got == best(rows, 5)
    assert counts.pairs >= 48 * 150 and counts.left < counts.pairs / 5


def test_bounds_skip_blocks(monkeypatch):
    """Blocks whose bound is under the k-th score are never scored."""
    seen = []
    real = topk._exact
    monkeypatch.setattr(topk, "_exact", lambda *a: seen.append(1) or real(*a))
    blocks = [(np.arange(k * 10, k * 10 + 10), np.full((10, 4), float(k))) for k in range(20)]
    got = list(topk.search_run((np.array([-1]), np.ones((1, 4))), blocks, 5))
    assert [s for _, _, s in got] == [76] * 5 and len(seen) == 1 and re.fullmatch(r"19\d", str(got[0][1]))
