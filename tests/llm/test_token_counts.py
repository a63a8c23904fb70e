import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from activlake.llm.token_counts import allocate, count_tokens, section_bounds, totals
from activlake.llm.tokens import char_spans, encode, vocabulary_path

PATH = vocabulary_path()
TOKENIZER = Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=80))
def test_ids_and_offsets_equal_the_tokenizers_library(text):
    want = TOKENIZER.encode(text, add_special_tokens=False)
    ids = encode(text, PATH)
    assert ids.tolist() == want.ids
    starts, ends = char_spans(text, ids, PATH)
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == want.offsets


def test_special_strings_and_both_files_of_the_vocabulary():
    text = "<|endoftext|> It's 12 o'clock\n\n  🙂🙂 naïve"
    assert encode(text, PATH).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
    assert 50256 in encode(text, PATH).tolist()
    starts, ends = char_spans(text, encode(text, PATH), PATH)
    assert (starts[0], ends[0]) == (0, 13)
    other, plain = vocabulary_path("byte_bpe_50k.tiktoken"), text.replace("<|endoftext|>", "<|end|>")
    assert encode(plain, PATH).tolist() == encode(plain, other).tolist()
    assert 50256 not in encode(text, other).tolist()  # this file has no added tokens


def test_rules_for_tokens_that_cross():
    starts, ends = np.array([0, 2, 5, 9]), np.array([2, 5, 9, 10])
    bounds = np.array([0, 3, 3, 8, 10])  # one empty section; tokens 2-5 and 5-9 cross
    assert allocate(starts, ends, bounds, "start").tolist() == [2, 0, 1, 1]
    assert allocate(starts, ends, bounds, "majority").tolist() == [1, 0, 2, 1]
    split = allocate(starts, ends, bounds, "split")
    assert split.tolist() == pytest.approx([1 + 1 / 3, 0, 2 / 3 + 3 / 4, 1 / 4 + 1])
    tie = allocate(np.array([0]), np.array([4]), np.array([0, 2, 4]), "majority")
    assert tie.tolist() == [1, 0]


def test_sections_tile_the_fields():
    bounds, owner = section_bounds(["a\nbc\n", "", "d"], by_line=True)
    assert (bounds, owner) == ([0, 2, 5, 5, 5, 6], [0, 0, 0, 1, 2])
    assert section_bounds(["a\nb", ""], by_line=False) == ([0, 3, 3], [0, 1])


@pytest.mark.parametrize("rule", ["majority", "start", "split"])
def test_counts_add_up_to_whole_documents(spark, rule):
    texts = ["Two lines\nof text", "", None, "🙂\n\n\n  indented\n", "x" * 300_000 + "\n" + "y z " * 9]
    rows = [(i, "Title", t, 5, 1) for i, t in enumerate(texts)] + [(None, None, "a b", 5, 1)]
    rows += [rows[0], (2**60 + 1, None, "wide", 5, 1)]
    df = spark.createDataFrame(rows, "doc_id long, title string, text string, n_tokens int, start int")
    got = count_tokens(df, fields=("title", "text"), rule=rule)
    sums = {r.doc_id: r.n_tokens for r in totals(got, "doc_id").collect()}
    for i, t in enumerate(texts):
        n = len(TOKENIZER.encode("Title" + (t or ""), add_special_tokens=False).ids)
        assert sums[i] == pytest.approx(n * (2 if i == 0 else 1))
    assert sums[None] == 2 and sums[2**60 + 1] == 1
    fields = {(r.doc_id, r.field) for r in got.collect()}
    assert (2, "text") in fields and (2, "title") in fields


def test_empty_table_and_unknown_rule(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(df).count() == 0
    with pytest.raises(ValueError):
        count_tokens(df, rule="fair")
