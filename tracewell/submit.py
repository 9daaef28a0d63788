"""Submit an export to a cluster: check the surroundings, pin the threads of numeric libraries, call spark-submit.

``python -m tracewell.submit [--master URL] [--executors N] [--cores N] [--memory 8g] [--dry_run] -- CLI flags``
"""

from __future__ import annotations

import argparse
import os
import shlex
import shutil
import subprocess
import sys
import tempfile
import zipfile
from pathlib import Path

#: Variables that bound the threads of numeric libraries; a task owns one core.
THREADS = ("OMP_NUM_THREADS", "MKL_NUM_THREADS", "OPENBLAS_NUM_THREADS", "NUMEXPR_NUM_THREADS")
NEEDED = ("numpy", "pyarrow", "pandas")


def missing(python: str) -> list[str]:
    """Modules that the workers' Python lacks."""
    return [m for m in NEEDED if subprocess.run([python, "-c", f"import {m}"], capture_output=True).returncode]


def package(folder: str) -> str:
    """This package as an archive for the executors."""
    root, out = Path(__file__).resolve().parent, f"{folder}/tracewell.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in root.rglob("*.py"):
            z.write(f, Path("tracewell") / f.relative_to(root))
    return out


def command(args: argparse.Namespace, archive: str, flags: list[str]) -> list[str]:
    conf = {"spark.executor.instances": args.executors, "spark.executor.cores": args.cores, "spark.executor.memory": args.memory, "spark.sql.adaptive.enabled": "true"}
    if args.shared:
        conf["spark.checkpoint.dir"] = args.shared
    conf |= {f"spark.executorEnv.{v}": 1 for v in THREADS}
    return [shutil.which("spark-submit") or "spark-submit", *(["--master", args.master] if args.master else []), *(x for k, v in conf.items() for x in ("--conf", f"{k}={v}")), "--py-files", archive, str(Path(__file__).resolve().parent / "cli.py"), *flags]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tracewell.submit", description=__doc__)
    p.add_argument("--master")
    p.add_argument("--executors", type=int, default=2)
    p.add_argument("--cores", type=int, default=4)
    p.add_argument("--memory", default="8g")
    p.add_argument("--shared", help="folder that driver and executors share (spark.checkpoint.dir)")
    p.add_argument("--python", default=sys.executable)
    p.add_argument("--dry_run", action="store_true", help="print the command only")
    p.add_argument("flags", nargs=argparse.REMAINDER)
    args = p.parse_args(argv)
    flags = args.flags[1:] if args.flags[:1] == ["--"] else args.flags
    if not flags:
        p.error("no flags for the export after --")
    if lacks := missing(args.python):
        print(f"{args.python} lacks {', '.join(lacks)}", file=sys.stderr)
        return 3
    with tempfile.TemporaryDirectory() as folder:
        call = command(args, package(folder), flags)
        print(shlex.join(call))
        if args.dry_run:
            return 0
        if shutil.which("spark-submit") is None:
            print("spark-submit is not on the path", file=sys.stderr)
            return 3
        return subprocess.run(call, env=os.environ | dict.fromkeys(THREADS, "1") | {"PYSPARK_PYTHON": args.python}).returncode


if __name__ == "__main__":
    sys.exit(main())
