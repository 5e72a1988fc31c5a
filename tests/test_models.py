"""The model queries run the profiles as they are."""

from kanaat.operators import training
from kanaat.plans import models


def test_profiles_are_whole():
    assert models.ELEVEN is training.ELEVEN and models.SEVEN is training.SEVEN


def test_both_categories_are_read(spark):
    made = models._learner("gnb")(spark, "/root/testdata/sf0.001").collect()
    assert {r.category for r in made} == {"quality", "toxic"}
