import io
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import rans as R
from millrace.llm.tokens import Encoder, public_file


class Opened(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def ids_of(seed, n, top=50257):
    random = np.random.default_rng(seed)
    return np.minimum(random.zipf(1.3, n) - 1, top - 1).astype("<u4")


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 100_000, 700_001])
def test_file_round_trip(n):
    ids = ids_of(n, n)
    cuts = sorted({0, n, *np.random.default_rng(1).integers(0, n + 1, 5).tolist()})
    documents = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    data = R.encode_file(documents)
    index = R.read_index(Opened(data))
    read = [R.read_block(Opened(data), index, k) for k in range(len(index["blocks"]))]
    assert (np.concatenate(read) if read else np.zeros(0)).tolist() == ids.tolist()
    assert index["documents"] == [len(d) // 4 for d in documents]
    if n == 700_001:
        assert len(index["blocks"]) == 2
        counts = np.bincount(ids)
        share = counts[counts > 0] / n
        assert len(data) * 8 < n * (-(share * np.log2(share)).sum()) * 1.06 + 8 * 200_000


def test_decoding_from_checkpoints():
    ids = ids_of(3, 500_000).astype(np.int64)
    freq = R.frequencies(np.bincount(ids))
    start, table = np.cumsum(freq) - freq, R.slots(freq)
    payload, entry = R.encode_block(ids, freq, start)
    assert entry["points"]
    for point, (step, _) in enumerate(entry["points"]):
        part = R.decode_block(payload, entry, freq, start, table, point, 3)
        first = step * entry["lanes"]
        assert part.tolist() == ids[first : first + 3 * entry["lanes"]].tolist()


def test_frequencies():
    random = np.random.default_rng(4)
    for counts in ([1], [0, 5, 0, 1], [10**9, 1, 1], random.integers(0, 3, 50_000), np.ones(50_257, int), random.zipf(1.2, 50_000)):
        freq = R.frequencies(np.array(counts))
        assert freq.sum() == 1 << R.PRECISION
        assert ((freq > 0) == (np.array(counts) > 0)).all()


def test_damage_is_found():
    data = bytearray(R.encode_file([ids_of(1, 5000).tobytes()]))
    index = R.read_index(Opened(bytes(data)))
    data[index["blocks"][0]["at"] + 100] ^= 1
    with pytest.raises(ValueError):
        R.read_block(Opened(bytes(data)), index, 0)


def test_documents_in_order(documents, words):
    random.seed(5)
    docs = [(i * 3, words(i, random.choice([0, 5, 400]))) for i in range(80)] + [(1000, None), (1001, ""), (1002, words(1, 20_000)), (None, "null id")]
    random.shuffle(docs)
    library = Tokenizer.from_file(public_file())
    manifest = R.write(documents(docs), file_ids=20_000)
    assert manifest.count() > 1
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in R.read(manifest).collect()}
    at = 0
    for doc, text in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [R.END], "<u4")
        assert got[doc] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(docs)


def test_repeated_rows_and_empty_table(documents):
    got = sorted((r["start"], r["n_tokens"]) for r in R.read(R.write(documents([(1, "a"), (1, "a"), (1, "b c")]))).collect())
    assert [s for s, _ in got] == [0, got[0][1], got[0][1] + got[1][1]]
    assert R.read(R.write(documents([]))).count() == 0


def test_ranges_from_checkpoints():
    ids = ids_of(9, 1_300_000)
    data = R.encode_file([ids.tobytes()], ["d"], (3, 4))
    index = R.read_index(Opened(data))
    assert index["names"] == ["d"] and R.read_place(Opened(data)) == (3, 4, len(ids), 3) and len(index["blocks"]) == 3
    for first, last in [(0, 1), (5, 5), (0, len(ids)), (262_144, 262_145), (500_000, 1_100_000), (1_299_999, 1_300_000), (524_288, 524_290)]:
        assert R.read_ids(Opened(data), index, first, last).tolist() == ids[first:last].tolist()


def test_the_files_alone_give_the_documents(documents, words):
    docs = [(i, words(i, 300)) for i in range(400)] + [(777, words(9, 400))] * 30 + [(-5, words(1, 30_000)), (9_000_000_000, None)]
    manifest = R.write(documents(docs, partitions=8), file_ids=4_000)
    assert manifest.columns == ["path"]
    assert manifest.count() >= 8
    read = R.read(manifest)
    tasks = read.select("doc_id", F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) >= 8  # with adaptive execution on
    library = Tokenizer.from_file(public_file())
    sizes = {d: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in docs}
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in read.collect())
    assert [d for _, d, _ in got] == sorted(d for d, _ in docs)
    at = 0
    for start, doc, n in got:
        assert (start, n) == (at, sizes[doc])
        at += n


def test_units_of_one_file_in_several_tasks(documents, words):
    """One file of several blocks, with documents across them and one over more than a block."""
    docs = [(i, words(i, 4_000)) for i in range(60)] + [(100, words(5, 260_000)), (101, words(6, 10))]
    manifest = R.write(documents(docs).coalesce(1), file_ids=10**9)
    whole, parts = R.read(manifest, unit_blocks=100), R.read(manifest, unit_blocks=1)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    if manifest.count() < 5:
        assert parts.groupBy(F.spark_partition_id()).count().count() > manifest.count()


def test_a_document_over_several_blocks(documents, words, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_IDS", 1000)
    data = [R.np.frombuffer(ids_of(i, n).tobytes(), "<u4") for i, n in enumerate([10, 3500, 1, 900, 2500])]
    file = R.encode_file([d.tobytes() for d in data])
    index = R.read_index(Opened(file))
    whole = np.concatenate(data)
    ends = np.cumsum([len(d) for d in data])
    for a, b in zip(ends - [len(d) for d in data], ends):
        assert R.read_ids(Opened(file), index, int(a), int(b)).tolist() == whole[a:b].tolist()


def test_new_words_of_letters_are_encoded_without_the_pattern():
    """Only what may be more than one word to the pattern is given to the library with it; ids are the library's."""
    encoder, library = Encoder(public_file()), Tokenizer.from_file(public_file())
    random.seed(8)
    letters = ["abcdefghijklmnop", "ABCxyz", "àéîöüßøñ", "ÀÉÖØ", "жшыѐҁ", "αβγω", "一龥水", "ªºµ", "×÷", " ", "٣", "0123", "'", "-_", "’", "😀", "é", "­", "Ġł"]
    words = ["".join(random.choice(random.choice(letters[: random.choice([1, 3, 7, 19])])) for _ in range(random.randrange(1, 12))) for _ in range(4000)]
    words += ["don't", "it's", "a b", " ", "  ", "à ", "x" * 3000, "<|endoftext|>", "a<|endoftext|>b", "end.", "end..."]
    texts = [" ".join(random.choices(words, k=random.randrange(1, 80))) for _ in range(400)]
    texts += [text.replace(" ", "\n", 3) for text in texts[:100]] + ["", " ", "à   à"]
    for _ in range(2):  # the second time from the memory
        got = encoder.encode(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]

    class Counted:
        chars = 0

        def encode_batch_fast(self, texts, **options):
            self.chars += sum(map(len, texts))
            return library.encode_batch_fast(texts, **options)

    encoder.library = Counted()
    fresh = [f"Start {' '.join('q' + ''.join(random.choices('abcdefgh', k=9)) for _ in range(500))}" for _ in range(3)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(fresh)] == [library.encode(t, add_special_tokens=False).ids for t in fresh]
    assert encoder.library.chars < 100


def test_a_tokenizer_whose_tokens_reach_over_words_keeps_the_pattern(tmp_path):
    whole = json.loads(Tokenizer.from_file(public_file()).to_str())
    for change in ("token", "split", "dropout", "added", "none"):
        spec = json.loads(json.dumps(whole))
        if change == "token":
            spec["model"]["vocab"]["eĠt"] = 60_000
        if change == "split":
            spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, spec["pre_tokenizer"]]}
        if change == "dropout":
            spec["model"]["dropout"] = 0.5
        if change == "added":
            spec["added_tokens"].append(spec["added_tokens"][0] | {"id": 50_257, "content": "xqx"})
        (tmp_path / change).write_text(json.dumps(spec))
        assert (Encoder(str(tmp_path / change)).words is None) == (change != "none")


def test_states_at_their_limits():
    """The bytes are those of the plain steps on whole numbers, also for frequencies of 1 and of all slots."""
    for counts in ([5000], [1, 4999], [1] * 5000, [4000, 1, 0, 999]):
        ids = np.random.default_rng(2).permutation(np.repeat(np.arange(len(counts)), counts))
        freq = R.frequencies(np.array(counts))
        start = np.cumsum(freq) - freq
        payload, entry = R.encode_block(ids, freq, start)
        lanes, words = entry["lanes"], []
        state = [1 << 31] * lanes
        for step in range(-(-len(ids) // lanes) - 1, -1, -1):
            sent = []
            for lane, i in enumerate(ids[step * lanes : (step + 1) * lanes].tolist()):
                f = int(freq[i])
                if state[lane] >= f << (63 - R.PRECISION):
                    sent.append(state[lane] & 0xFFFFFFFF)
                    state[lane] >>= 32
                state[lane] = (state[lane] // f << R.PRECISION) + state[lane] % f + int(start[i])
            words = sent + words
        assert not entry["points"] and payload == np.array(state, "<u8").tobytes() + np.array(words, "<u4").tobytes()
        assert R.decode_block(payload, entry, freq, start, R.slots(freq)).tolist() == ids.tolist()
