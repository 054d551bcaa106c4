"""Command line for the batch jobs (one ``spark-submit`` step each).

    python -m churnlens clean    -i log.json        -o cleaned.parquet
    python -m churnlens features -i cleaned.parquet -t train.parquet -v validation.parquet
    python -m churnlens train    -a lr|svm|nb|rf|all -i train.parquet -o models/lr
    python -m churnlens evaluate -i validation.parquet -m models/lr
    python -m churnlens compare  -m svm=models/svm lr=models/lr ...
    python -m churnlens explore  -i cleaned.parquet -o exploration/

Scoring users straight from a raw log, and the profile of a log's fields:

    python -m churnlens scorer -a lr -i train.parquet -o models/scorer
    python -m churnlens score  -i log.json -m models/scorer -o scores.parquet
    python -m churnlens drift  -i log.json
    python -m churnlens search -i train.parquet -o models/ -a nb lr --wide

The two workflows, with a ledger so that a rerun goes on after the last finished step:

    python -m churnlens preprocess -i log.json -c cleaned.parquet -t train.parquet -v validation.parquet --ledger ledger/
    python -m churnlens models -t train.parquet -v validation.parquet -o models/ --ledger ledger/

Runs where it is submitted: only runtime SQL settings are set here.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The session of the submit: master, memory and partitions are the submitter's."""
    from churnlens.session import ensure_core_conf

    spark = SparkSession.builder.appName("churnlens").getOrCreate()
    ensure_core_conf(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="churnlens")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clean")
    c.add_argument("-i", "--input_file", required=True)
    c.add_argument("-o", "--output_file", required=True)
    c.add_argument("--format", default="json")
    c.add_argument("--mode", default="errorifexists", help="e.g. overwrite, to rerun a failed step")
    c.add_argument("--bad-lines", default="fail", choices=["fail", "keep"],
                   help="fail on lines that do not fit the schema, or keep them beside the output")
    f = sub.add_parser("features")
    f.add_argument("-i", "--input", required=True)
    f.add_argument("-t", "--traintest")
    f.add_argument("-v", "--validation")
    f.add_argument("--publish", help="instead of -t and -v: a folder where both tables are published as one commit")
    f.add_argument("--split", default="hash", choices=["hash", "random"])
    f.add_argument("--mode", default="errorifexists")
    t = sub.add_parser("train")
    t.add_argument("-a", "--algo", required=True)
    t.add_argument("-i", "--input_data", required=True)
    t.add_argument("-o", "--output_model", required=True)
    e = sub.add_parser("evaluate")
    e.add_argument("-i", "--input_path", required=True)
    e.add_argument("-m", "--model_path", required=True)
    x = sub.add_parser("explore")
    x.add_argument("-i", "--input", required=True)
    x.add_argument("-o", "--output_dir", required=True)
    x.add_argument("--mode", default="errorifexists")
    m = sub.add_parser("compare")
    m.add_argument("-m", "--models", nargs="+", required=True, help="algo=path ...")
    r = sub.add_parser("scorer")
    r.add_argument("-a", "--algo", required=True)
    r.add_argument("-i", "--input_data", required=True)
    r.add_argument("-o", "--output_model", required=True)
    z = sub.add_parser("score")
    z.add_argument("-i", "--input_file", required=True)
    z.add_argument("-m", "--model_path", required=True)
    z.add_argument("-o", "--output_file", required=True)
    z.add_argument("--format", default="json")
    z.add_argument("--mode", default="errorifexists")
    d = sub.add_parser("drift")
    d.add_argument("-i", "--input_file", required=True)
    y = sub.add_parser("search")
    y.add_argument("-i", "--input_data", required=True)
    y.add_argument("-o", "--model_root", required=True)
    y.add_argument("-a", "--algos", nargs="+", default=None)
    y.add_argument("--wide", action="store_true", help="the wide grids instead of the single maps")
    w = sub.add_parser("preprocess")
    for flag, name in (("-i", "--input_file"), ("-c", "--cleaned"), ("-t", "--traintest"), ("-v", "--validation"), (None, "--ledger")):
        w.add_argument(*[x for x in (flag, name) if x], required=True)
    w.add_argument("--format", default="json")
    w.add_argument("--until", help="the last step to run")
    n = sub.add_parser("models")
    for flag, name in (("-t", "--traintest"), ("-v", "--validation"), ("-o", "--model_root"), (None, "--ledger")):
        n.add_argument(*[x for x in (flag, name) if x], required=True)
    n.add_argument("-a", "--algos", nargs="+", default=None)
    n.add_argument("--until")
    args = p.parse_args(argv)
    if args.job == "features" and not args.publish and not (args.traintest and args.validation):
        p.error("features needs -t and -v, or --publish")

    spark = _session()
    if args.job == "clean":
        from churnlens.plans.clean_job import run_clean
        run_clean(spark, args.input_file, args.output_file, fmt=args.format, mode=args.mode,
                  bad_lines=args.bad_lines)
    elif args.job == "features":
        from churnlens.plans.feature_job import publish_features, run_features
        if args.publish:
            publish_features(spark, args.input, args.publish, method=args.split)
        else:
            run_features(spark, args.input, args.traintest, args.validation, method=args.split, mode=args.mode)
    elif args.job == "scorer":
        from churnlens.plans.score_job import run_scorer_training
        run_scorer_training(spark, args.algo, args.input_data, args.output_model)
    elif args.job == "score":
        from churnlens.plans.score_job import run_scoring
        run_scoring(spark, args.input_file, args.model_path, args.output_file, fmt=args.format, mode=args.mode)
    elif args.job == "drift":
        from churnlens.sources.drift import schema_drift
        schema_drift(spark, args.input_file).orderBy("field").show(1000, truncate=False)
    elif args.job == "search":
        from churnlens.operators.ml import ALGORITHMS
        from churnlens.operators.search import WIDE_GRIDS
        from churnlens.plans.train_job import run_search
        found = run_search(spark, args.input_data, args.model_root, tuple(args.algos or ALGORITHMS),
                           grids=WIDE_GRIDS if args.wide else None)
        for algo, x in found.items():
            print(algo, x.grid[x.best], x.means[x.best])
    elif args.job == "preprocess":
        from churnlens.plans.workflows import preprocess
        for step in preprocess(spark, args.input_file, args.cleaned, args.traintest, args.validation, fmt=args.format,
                               ledger=args.ledger, until=args.until):
            print(*step)
    elif args.job == "models":
        from churnlens.operators.ml import ALGORITHMS
        from churnlens.plans.workflows import train_and_evaluate
        table = train_and_evaluate(spark, args.traintest, args.validation, args.model_root,
                                   tuple(args.algos or ALGORITHMS), ledger=args.ledger, until=args.until)
        if table is not None:
            table.show(truncate=False)
    elif args.job == "train":
        from churnlens.plans.train_job import run_training
        run_training(spark, args.algo, args.input_data, args.output_model)
    elif args.job == "evaluate":
        from churnlens.plans.evaluate_job import run_evaluation
        run_evaluation(spark, args.input_path, args.model_path).show(truncate=False)
    elif args.job == "explore":
        from churnlens.plans.explore_job import run_exploration
        run_exploration(spark, args.input, args.output_dir, mode=args.mode)
    elif args.job == "compare":
        from churnlens.plans.compare import compare_models
        paths = dict(x.split("=", 1) for x in args.models)
        compare_models(spark, paths).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
