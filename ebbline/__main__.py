"""Run one step: ``python -m ebbline <step> --option value ...`` (also through spark-submit)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ebbline import jobs, params
from ebbline.plans.boosting import BoostingConfig
from ebbline.session import get_session


def _collect_ids(spark: SparkSession, a: argparse.Namespace) -> None:
    sweep = spark.read.parquet(a.sweep_pages) if a.sweep_pages else None
    jobs.collect_ids(spark.read.parquet(a.list_pages), sweep, a.out)


def _pull_metrics(spark: SparkSession, a: argparse.Namespace) -> None:
    jobs.pull_metrics(spark, spark.read.parquet(a.pages), a.ids, a.out, a.max_ids).show()


def _stream_metrics(spark: SparkSession, a: argparse.Namespace) -> None:
    jobs.stream_metrics(spark, a.pages, a.out, a.checkpoint, a.progress).show()


def _pull_metadata(spark: SparkSession, a: argparse.Namespace) -> None:
    jobs.pull_metadata(spark, spark.read.parquet(a.documents), a.metrics, a.parts, a.merged, a.failures)


def _load_warehouse(spark: SparkSession, a: argparse.Namespace) -> None:
    star = jobs.load_warehouse(spark, a.monthly, a.metadata, a.root)
    if a.marts:
        jobs.export_marts(star, a.marts)


def _train(spark: SparkSession, a: argparse.Namespace) -> None:
    jobs.train(spark, a.panel, a.vocabulary, a.split, a.out, BoostingConfig(rounds=a.rounds)).show(vertical=True)


STEPS = {
    "collect-ids": (_collect_ids, {"list-pages": str, "sweep-pages": None, "out": str}),
    "pull-metrics": (_pull_metrics, {"pages": str, "ids": str, "out": str, "max-ids": params.MAX_IDS}),
    "stream-metrics": (_stream_metrics, {"pages": str, "out": str, "checkpoint": str, "progress": str}),
    "pull-metadata": (_pull_metadata, {"documents": str, "metrics": str, "parts": str, "merged": str, "failures": str}),
    "prepare-load": (lambda s, a: jobs.prepare_load(s, a.merged, a.out), {"merged": str, "out": str}),
    "load-warehouse": (
        _load_warehouse, {"monthly": str, "metadata": str, "root": str, "marts": None}
    ),
    "make-panel": (
        lambda s, a: jobs.make_panel(s, a.metrics, a.merged, a.vocabulary, a.out),
        {"metrics": str, "merged": str, "vocabulary": str, "out": str},
    ),
    "train": (_train, {"panel": str, "vocabulary": str, "split": str, "out": str, "rounds": params.N_TREES}),
    "predict": (lambda s, a: jobs.predict(s, a.input, a.model, a.out), {"input": str, "model": str, "out": str}),
}
INTEGERS = {"max-ids", "rounds"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ebbline")
    steps = top.add_subparsers(dest="step", required=True)
    for name, (_, options) in STEPS.items():
        step = steps.add_parser(name)
        for option, default in options.items():
            kind = int if option in INTEGERS else str
            step.add_argument(f"--{option}", type=kind, required=default is str, default=None if default is str else default)
    return top


def main(arguments: list[str] | None = None) -> None:
    chosen = parser().parse_args(arguments)
    STEPS[chosen.step][0](get_session(f"ebbline {chosen.step}"), chosen)


if __name__ == "__main__":
    main()
