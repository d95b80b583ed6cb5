"""Rejection of near languages and noise, with short clean texts kept."""

import random
from pathlib import Path

import numpy as np
import pytest

from inkmill.llm import language

DATA = Path("/root/testdata/sf0.1")
NEAR = (
    "De kat zat op de mat en keek naar de vogels die in de tuin vlogen, terwijl de kinderen met hun vrienden buiten speelden en de zon langzaam achter de bomen verdween. Het was een mooie avond en niemand wilde naar huis gaan.",
    "Il gatto sedeva sul tappeto e guardava gli uccelli che volavano nel giardino mentre i bambini giocavano con i loro amici fuori e il sole spariva lentamente dietro gli alberi.",
    "Katten satt på mattan och tittade på fåglarna som flög i trädgården medan barnen lekte med sina vänner utanför och solen sakta försvann bakom träden.",
)


def hex_words(seed):
    r = random.Random(seed)
    return " ".join(f"{r.getrandbits(160):040x}" for _ in range(60))


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_near_languages_and_noise(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    model = language.fit(docs)
    far = model.predict(np.stack([language.vector(t) for t in (*NEAR, *map(hex_words, range(3)))]))[2]
    assert far.all()
    short = [r["text"] for r in docs.where("length(text) between 30 and 400").select("text").collect()]
    assert len(short) > 200 and model.predict(np.stack([language.vector(t) for t in short]))[2].mean() < 0.03
    long = [r["text"] for r in docs.where("length(text) > 2000").limit(500).collect()]
    assert not model.predict(np.stack([language.vector(t) for t in long]))[2].any()


def test_one_odd_text_does_not_set_the_bound():
    r = random.Random(5)
    words = ["".join(r.choices("aeinrst", k=r.randint(2, 7))) for _ in range(300)]
    clean = [" ".join(r.choices(words, k=120)) for _ in range(100)]
    without = language.fit_vectors(["x"] * 100, np.stack([language.vector(t) for t in clean]))
    odd = language.fit_vectors(["x"] * 100, np.stack([language.vector(t) for t in [*clean[:99], clean[99][:300] + hex_words(1)]]))
    assert odd.floors[0, 9] > 0.9 * without.floors[0, 9]
