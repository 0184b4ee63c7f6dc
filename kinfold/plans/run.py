"""A whole run: train on labelled sources, tune, and match the test sources.

    python -m kinfold.plans.run --train DIR --test DIR --work DIR --output DIR
"""

from __future__ import annotations

import argparse
import json

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators import model as M
from kinfold.operators.features import pair_features
from kinfold.operators.graph import assign_splits, sample_candidates, select_queries
from kinfold.operators.index import Index, word_idf
from kinfold.operators.metrics import difficulty_tags, evaluate, threshold_search
from kinfold.operators.records import ingest, load_truth
from kinfold.operators.retrieve import retrieve, text_channels
from kinfold.operators.spelling import apply_spelling, learn_spelling, rule_map
from kinfold.operators.store import exists, read_text, saved, write_file
from kinfold.sources.tsv import TRUTH_COLUMNS, read_pairs, read_tsv, validate_outputs, write_outputs, write_pairs

#: Queries drawn from each split.
LIMITS = {"fit": 50_000, "stop": 5_000, "cal_fit": 10_000, "cal_select": 5_000, "tune": 10_000, "final": 10_000}


def read_records(spark: SparkSession, folder: str, prefix: str, rules: dict[str, str] | None = None) -> DataFrame:
    return saved(ingest({s: read_tsv(spark, f"{folder}/{prefix}_source{s}.tsv", places=True) for s in (1, 2, 3)}, rules))


def dependencies() -> dict[str, str]:
    return {"pyspark": pyspark.__version__}


def core_run(spark: SparkSession, train: str, test: str, work: str, out: str, kinds: tuple[str, ...] = ("char", "rare", "translit"), k: int = 60, verified: bool = False, trees: int = M.TREES) -> dict:
    """Trains, tunes and validates on ``train``, writes the model, the index and a report to ``work`` and
    the two result files for ``test`` to ``out``; all are folders of any file system that the driver and
    the executors share.  Each split serves one decision."""
    if exists(spark, f"{work}/report.json"):
        raise ValueError("use a fresh work folder")
    records = read_records(spark, train, "train")
    queries, truth = load_truth(records, read_tsv(spark, f"{train}/train_ground_truth.tsv", TRUTH_COLUMNS))
    queries, truth = saved(queries), saved(truth)
    splits = saved(assign_splits(queries, truth))
    rules = rule_map(learn_spelling(records, truth, splits))
    records = saved(apply_spelling(records, rules))
    table = saved(word_idf(records))
    sets = {s: saved(select_queries(splits, s, n)) for s, n in LIMITS.items()}
    if any(not q.limit(1).count() for q in sets.values()):
        raise ValueError("every split needs queries; use more data")
    Index(records, text_channels(kinds)).save(f"{work}/index")
    index = Index.load(spark, f"{work}/index")

    def pairs(split: str) -> DataFrame:
        wanted = records.join(sets[split].withColumnRenamed("q", "rid"), "rid", "left_semi").unionByName(records.where("source <> 1"))
        found = retrieve(wanted, kinds, k, verified, index)
        found = sample_candidates(found, truth) if split == "fit" else found.join(truth.withColumn("y", F.lit(1)), ["q", "t"], "left").fillna(0, ["y"])
        found = saved(found)
        made = pair_features(found, records, table).join(found.select("q", "t", "y"), ["q", "t"])
        write_pairs(made, f"{work}/{split}.parquet")
        return read_pairs(spark, f"{work}/{split}.parquet")

    tables = {s: pairs(s) for s in LIMITS}
    model = M.train_model(tables["fit"], tables["stop"], trees)
    scored = {s: M.predict(model, tables[s]).select("q", "t", "y", "p") for s in ("cal_fit", "cal_select", "tune", "final")}
    calibrator, losses = M.choose_calibrator(saved(scored["cal_fit"]), saved(scored["cal_select"]))
    final = {s: saved(calibrator.predict(scored[s]).select("q", "t", "p")) for s in ("tune", "final")}
    of = lambda s: truth.join(sets[s], "q", "left_semi")
    tau, score = threshold_search(sets["tune"], of("tune"), final["tune"])
    slices = evaluate(sets["final"], of("final"), final["final"], tau, difficulty_tags(sets["final"], of("final"), records))
    report = {
        "calibration_brier": losses, "calibrator": calibrator.kind, "threshold": tau, "tune_f05": score, "final": {r.tag: {k: v for k, v in r.asDict().items() if k != "tag"} for r in slices.collect()},
        "rules": rules, "k": k, "kinds": list(kinds), "country_verified": verified, "dependencies": dependencies(),
    }
    model.write().overwrite().save(f"{work}/model")
    calibrator.save(f"{work}/calibrator")
    table.write.mode("overwrite").parquet(f"{work}/feature_idf.parquet")
    write_file(spark, f"{work}/report.json", json.dumps(report, indent=2))
    infer(spark, read_records(spark, test, "test", rules), table, model, calibrator, tau, out, kinds, k, verified)
    return report


def infer(spark, records, table, model, calibrator, tau, out, kinds, k=60, verified=False) -> None:
    """Scores every candidate once and writes and checks the two result files."""
    found = saved(retrieve(records, kinds, k, verified))
    scored = saved(calibrator.predict(M.predict(model, pair_features(found, records, table)).select("q", "t", "p")))
    write_outputs(records, scored, tau, out)
    validate_outputs(spark, records, out)


def infer_from(spark: SparkSession, work: str, test: str, out: str) -> None:
    """Matches the test sources with what a training run left in ``work``."""
    report = json.loads(read_text(spark, f"{work}/report.json"))
    records, calibrator = read_records(spark, test, "test", report["rules"]), M.Calibrator.load(f"{work}/calibrator", report["calibrator"])
    table, model = spark.read.parquet(f"{work}/feature_idf.parquet"), PipelineModel.load(f"{work}/model")
    infer(spark, records, table, model, calibrator, report["threshold"], out, tuple(report["kinds"]), report["k"], report["country_verified"])


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--train", help="left out: match with what an earlier run left in --work")
    for name in ("test", "work", "output"):
        parser.add_argument(f"--{name}", required=True)
    args = parser.parse_args()
    spark = SparkSession.builder.getOrCreate()
    if not args.train:
        return infer_from(spark, args.work, args.test, args.output)
    print(json.dumps(core_run(spark, args.train, args.test, args.work, args.output), indent=2))


if __name__ == "__main__":
    main()
