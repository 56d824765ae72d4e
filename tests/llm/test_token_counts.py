"""Token counts of the compiled transducers against the tokenizers library."""

import json
import random

import numpy as np
import public_tokenizers
import pytest

from chronoweave.llm import queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
UNITS = ["'", "s", "t", "re", "ve", "ll", "d", "m", "r", "v", "l", "e", " ", "  ", "\n", "\t", " ", "　", "1", "٣", "!", "?"]
UNITS += ["a", "é", "中", "<|endoftext|>", "<|endo", "text|>", "\x1c", "\x85", "😀", "S", "'S", "’", "the", "ing", " un"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    drawn = ["".join(rng.choice(UNITS) for _ in range(rng.randint(0, 40))) for _ in range(4_000)]
    point = lambda: rng.choice([rng.randint(0, 127), rng.randint(0, 0x3000), rng.randint(0xE000, 0x10FFFF)])
    return drawn + ["".join(chr(point()) for _ in range(rng.randint(1, 40))) for _ in range(800)]


#: Ordinary blocks; blocks that cut nearly every text; a machine that starts anew all the time.
@pytest.mark.parametrize("settings", [{}, {"block_bytes": 16}, {"block_bytes": 256, "most_transitions": 300, "slot_bits": 13}])
def test_counts(library, texts, settings):
    some = texts[:: 10 if settings else 1]
    counter = token_counts.Counter(PATH, **settings)
    assert counter.counts([t.encode() for t in some]).tolist() == [library(t) for t in some]
    if "most_transitions" in settings:
        assert len(counter.machine.steps) < 4_000


def test_long_pieces_and_texts(library):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh") for _ in range(30_000)) + " " * 5_000 + "1" * 3_000 + "\n" * 40 + "x" * 9_000
    words = " ".join(rng.choice(["alpha", "beta's", "gamma\n", "中文字"]) for _ in range(400_000))
    counter = token_counts.Counter(PATH)
    assert counter.counts([text.encode(), words.encode()]).tolist() == [library(text), library(words)]


def test_prefix_scan_of_state_maps():
    rng = np.random.default_rng(5)
    kinds = rng.integers(0, token_counts.CLASSES, (7, 300)).astype(np.uint8)
    states = token_counts.entry_states(token_counts.state_maps(kinds))
    state, wanted = token_counts.START, []
    for column in kinds.T:
        wanted.append(state)
        for kind in column:
            state = int(token_counts.NEXT[state * token_counts.CLASSES + kind])
    assert states.tolist() == wanted


def test_added_tokens_over_seams_and_cuts(tmp_path):
    """Added tokens that begin where a match over two texts would end, and ones with white space inside."""
    from tokenizers import Tokenizer

    plan = json.loads(open(PATH).read())
    first = max(t["id"] for t in plan["added_tokens"] + [{"id": max(plan["model"]["vocab"].values())}]) + 1
    flags = dict.fromkeys(("single_word", "lstrip", "rstrip", "normalized"), False) | {"special": True}
    plan["added_tokens"] += [{"id": first + i, "content": c} | flags for i, c in enumerate(("aXa", "q! z", "aXaX"))]
    path = tmp_path / "more.json"
    path.write_text(json.dumps(plan))
    library = Tokenizer.from_file(str(path))
    texts = ["one aX", "aXa two", "", "aX", "aXaXa", "q!", " z q! z", "word q! z " * 40]
    wanted = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    for settings in ({}, {"block_bytes": 16}):
        assert token_counts.Counter(str(path), **settings).counts([t.encode() for t in texts]).tolist() == wanted


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.Counter(public_tokenizers.path("word_bpe_49k.json"))


def test_rows(spark, data_dir, library):
    docs = queries.table(spark, data_dir, "documents")
    odd = [(None, None, 1), (None, "", 1), (7, "a<|endoftext|>b", 1), (7, "a<|endoftext|>b", 1), (8, "word " * 200_000, 1)]
    odd = spark.createDataFrame(odd, "doc_id long, text string, n_tokens int")
    found = token_counts.digest(token_counts.count_tokens(docs.select("doc_id", "text").unionByName(odd.drop("n_tokens")), PATH)).collect()
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect() + odd.collect()]
    wanted = [(i, len(t.encode()), library(t), library(t) > 1_024) for i, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert token_counts.count_tokens(odd, PATH, keep=()).count() == 5 and token_counts.count_tokens(odd.limit(0), PATH).count() == 0
