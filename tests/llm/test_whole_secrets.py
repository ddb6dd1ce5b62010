"""Strings that a prefix or a fixed rule kept from the character models."""

import random
import string

from lastro.llm import secrets
from tests.llm.helpers import docs, words


def test_all_strings_of_a_sampled_text_train_the_models(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(secrets.MarkovPair, "fit", lambda *both: seen.extend(both))
    names = [f"name_number{k:03}" for k in range(150)]
    keys = [f"{k:04}" * 8 for k in range(150)]
    secrets.fit_models(docs(spark, [(1, " ".join(names + keys))]))
    assert set(names) <= set(seen[1]) and set(keys) <= set(seen[0])


def test_keys_without_digits_are_scored_and_ruled_lines_are_not_taken():
    chance = random.Random(9)
    model = secrets.MarkovPair.fit(
        secrets.generated_keys(2000, 3),
        secrets.ordinary_identifiers() + words(3000, 1).split())
    keys = ["".join(chance.choices(string.ascii_letters, k=24)) for _ in range(200)]
    caught = sum(secrets.spans_of(f"x {k} y", model) == [("random", 2, 26)] for k in keys)
    assert caught >= 190
    for line in ("-" * 30, "=" * 16, "_" * 50, "/" * 20, "A" * 17):
        assert secrets.spans_of(f"x\n{line}\ny", model) == []
