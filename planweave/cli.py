"""Command line: list and run registered queries, check a model document, ask it, export it."""

from __future__ import annotations

import argparse

from planweave.session import session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="planweave", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="names of the registered queries")
    run = sub.add_parser("run", help="run a registered query over a folder of tables")
    run.add_argument("name")
    run.add_argument("folder")
    run.add_argument("--out", help="write Parquet there instead of showing rows")
    for name, text in (("check", "the battery's report of a model document"), ("gate", "whether a model may be exported"), ("gbxml", "its energy model"), ("tables", "counts of its tables")):
        c = sub.add_parser(name, help=text)
        c.add_argument("model")
    ask = sub.add_parser("ask", help="a plain question about a model document")
    ask.add_argument("model")
    ask.add_argument("question")
    ask.add_argument("--bearing", type=float)
    diff = sub.add_parser("diff", help="spaces that changed between two model documents")
    diff.add_argument("old")
    diff.add_argument("new")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    from pyspark.sql import functions as F

    from planweave.checks import rules
    from planweave.model import document
    from planweave.operators import revisions
    from planweave.plans import catalog
    from planweave.query.engine import Engine
    from planweave.sinks import writers

    if a.command == "queries":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    spark = session("planweave-cli")
    spark.sparkContext.setLogLevel("ERROR")
    show = lambda df: df.show(1000, truncate=False)
    load = lambda path: document.tables(document.read(spark, path))
    model = lambda path: rules.Model(spark, **{k: v.drop("model_id") for k, v in load(path).items()})
    if a.command == "run":
        df = catalog.QUERIES[a.name](spark, a.folder)
        df.write.mode("overwrite").parquet(a.out) if a.out else show(df)
    elif a.command == "check":
        show(rules.run(model(a.model)))
    elif a.command == "gate":
        m = model(a.model)
        ok = rules.gate(rules.run(m), m.review).first().may_export
        print("may be exported" if ok else "may not be exported")
        return 0 if ok else 1
    elif a.command == "gbxml":
        print(writers.gbxml(load(a.model)).first().body)
    elif a.command == "tables":
        for name, t in load(a.model).items():
            print(name, t.count())
    elif a.command == "ask":
        answer = Engine(model(a.model), a.bearing).query(a.question).first()
        print(f"{answer.answer} ({answer.method})")
    elif a.command == "diff":
        of = lambda path: load(path)["spaces"]
        show(revisions.diff(of(a.old), of(a.new), "id", {"geometry": [revisions.number("area_m2", 4), revisions.number("volume_m3", 4), F.to_json("polygon_m")], "schedule": [F.to_json("openings")]}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
