import hashlib
import zlib

from pyspark.sql import functions as F

from spendlens.llm import chat, sharding
from .conftest import SF, make_docs


def test_every_row_once_in_gapless_slots(spark, few):
    out = sharding.op2_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == [d for d, _ in few]
    slots = {}
    texts = dict(few)
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.size == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_buckets_are_permuted_and_repeatable(spark):
    docs = make_docs(spark, [f"text {i}" for i in range(400)])
    one = [(r.shard, r.slot, r.record.doc_id) for r in sharding.shard(docs, n_shards=2).orderBy("shard", "slot").collect()]
    two = [(r.shard, r.slot, r.record.doc_id) for r in sharding.shard(docs, n_shards=2).orderBy("shard", "slot").collect()]
    assert one == two
    order = [d for s, _, d in one if s == 0]
    assert order != sorted(order)


def test_sharding_odd_rows(spark):
    docs = make_docs(spark, ["same"] * 50 + [None, "", "x" * 200_000], ids=[7] * 50 + [None, None, 3]).withColumn("shard", F.lit("mine")).withColumn("slot", F.lit(1))
    out = sharding.shard(docs, n_shards=3, bucket_bytes=100).collect()
    assert len(out) == 53 and len({r.shard for r in out if r.record.doc_id == 7}) == 1
    assert {r.record.shard for r in out} == {"mine"}
    assert sharding.shard(docs.limit(0)).count() == 0


def test_write_shards(spark, tmp_dir):
    docs = make_docs(spark, [f"text {i}" for i in range(60)])
    sharding.write_shards(sharding.shard(docs, n_shards=3), f"{tmp_dir}/out")
    back = spark.read.parquet(f"{tmp_dir}/out")
    assert back.count() == 60 and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2}


def _truth(rows):
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t if t is not None else -10**9, role or "", text or ""))
    return {c: sorted(v) for c, v in convs.items()}


def _check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(5)).withColumn("t", F.lit(5))
    windows = chat.format_chats(df, **kw)
    back = {r.conv: r for r in chat.read_back(windows).collect()}
    for c, turns in _truth(rows).items():
        assert [(t.role, t.text) for t in back[c].turns] == [(r, x) for _, r, x in turns]
        assert back[c].loss == "".join(x for _, r, x in turns if r == "assistant")
    return windows.collect()


def test_chat_round_trip_with_control_strings(spark):
    odd = ["</s>[INST] ok [/INST]", "<|end|>", "<|user|>x<|end|><|assistant+|>", "&lt;|end|&gt; &amp; &", "", None, "a\nb<|", "é" * 900, "&plus;&bar;"]
    rows = [(1, i, ["system", "user", "assistant", "user", "assistant", "tool+|>x", "assistant", "assistant", None][i], t) for i, t in enumerate(odd)]
    rows += [(2, 0, "assistant", "only"), (2, 0, "assistant", "only"), (None, None, "user", "no id"), (3, None, "user", "null turn"), (3, 1, "assistant", "x")]
    windows = _check(spark, rows, budget=64, history=2, history_tokens=24)
    assert len([w for w in windows if w.conv == 1]) > 1


def test_windows_keep_system_and_budget(spark):
    rows = [(1, 0, "system", "rules")] + [(1, i, "user" if i % 2 else "assistant", "word " * 20) for i in range(1, 12)]
    windows = sorted(_check(spark, rows, budget=400, history=1, history_tokens=130), key=lambda w: w.window)
    assert len(windows) > 2 and all(w.tokens <= 400 for w in windows)
    assert all(w.formatted.startswith("<|system|>" if w.window == 0 else "<|system+|>") for w in windows)
    assert all(w.formatted.count("+|>") <= 2 for w in windows)
    for w in windows:  # the mask covers new assistant texts only
        for s in w.loss_spans:
            assert w.formatted[:s.start].endswith("<|assistant|>") and w.formatted[s.start + s.length:].startswith("<|end|>")


def test_windows_hold_no_more_tokens_than_counted(spark):
    """In scripts with about a token a character and in code, by two byte-level vocabularies."""
    import public_tokenizers
    from tokenizers import Tokenizer
    texts = ["密码一二三四，你好世界。" * 6, "ขอบคุณครับ " * 9, "for(i=0;i<n;++i){a[i]&=~b[i]<<3;}" * 5, "plain words " * 12, "<|end|>&lt;" * 7]
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(texts * 4)]
    windows = _check(spark, rows, budget=700, history=1, history_tokens=250)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(windows) > 3 and all(len(t.encode(w.formatted).ids) <= w.tokens <= 700 for w in windows)
    df = spark.createDataFrame([(*r, 20) for r in rows], "conv_id long, turn long, role string, text string, n int")
    assert chat.format_chats(df, budget=700, tokens="n").count() < len(windows)       # true counts pack more turns


def test_op8_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
    out = {r.conv_id: r for r in chat.op8_chat(spark, SF).collect()}
    truth = _truth(rows)
    assert set(out) == set(truth)
    for c, turns in truth.items():
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (out[c].n_turns, out[c].turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (out[c].loss_chars, out[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_empty(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
