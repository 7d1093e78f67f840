"""From files to files: train a model, test it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from charloom.operators import evaluate
from charloom.operators.corpus import load_capped
from charloom.plans.model import CharModel, ModelParams
from charloom.sources import files, model_io


def train(spark: SparkSession, model_dir: str, listed: Sequence[str] | str | None = None,
          patterns: Sequence[str] = files.DEFAULT_PATTERNS, params: ModelParams = ModelParams(),
          max_lines: int | None = None, balanced: bool = False, prepared: str | None = None) -> CharModel:
    """Choose the corpus files (or take a ``prepared`` folder, a group per sub-folder), read
    and cap them, fit, and save the model in ``model_dir``."""
    if prepared is not None:
        lines = files.read_prepared(spark, prepared, keep_blank=True)
    else:
        lines = files.read_corpus(spark, files.corpus_files(spark, listed, patterns), keep_blank=True)
    model = CharModel.fit(load_capped(lines, max_lines, balanced), params)
    model_io.save(model, model_dir)
    return model


def test(spark: SparkSession, model_dir: str, input_path: str, output_path: str, k: int = 3,
         guess_table: bool = True) -> DataFrame:
    """Load the model, predict every line of ``input_path``, check that each input has its
    prediction, write them, and return the predictions.  ``guess_table`` scores the stored
    contexts first, so that inputs of any number are only looked up."""
    model = model_io.load(spark, model_dir).prepare(k, guess_table=guess_table)
    inputs = files.read_inputs(spark, input_path)
    preds = model.predict(inputs, k).select("qid", "pred")
    files.write_predictions(preds, output_path)
    evaluate.require_aligned(inputs, files.read_predictions(spark, output_path))
    return preds
