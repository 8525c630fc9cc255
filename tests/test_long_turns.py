"""Padding of the chunker report leaves long turns whole."""

from conftest import kvs, span

from spanloom.functions import attrs as A
from spanloom.plans import registry


def test_long_turns_stay_whole(spark, spans_df):
    turns = ["short", "é" * 1250, "x" * 2499, "я" * 2000, "".join(f"word{i} " for i in range(2000))]
    attributes = kvs(**{f"gen_ai.prompt.{i}.{k}": v for i, t in enumerate(turns) for k, v in (("role", "user"), ("content", t))})
    text = registry._padded(spans_df([span(attributes=attributes)])).select(A.string("gen_ai.input.messages")).first()[0]
    filled = [t if len(t.encode()) >= 2500 else ((t + " ") * 2500)[:2500] for t in turns]
    assert text == "\n".join(f"user: {t}" for t in filled)
