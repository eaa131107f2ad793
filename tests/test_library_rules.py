"""Static rules for the library code: no driver-side data pulls, no local
checkpoints, no Python UDFs (every transform stays in the JVM)."""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parent.parent / "leadlake"
FORBIDDEN = {
    r"\.collect\(": "collects rows to the driver",
    r"\.toPandas\(": "collects rows to the driver",
    r"\.take\(|\.first\(|\.head\(": "pulls rows to the driver",
    r"localCheckpoint": "loses data with an executor",
    r"\.checkpoint\(": "a job hidden in a transform",
    r"\.rdd\b": "leaves the optimizer",
    r"\.cache\(|\.persist\(": "hidden memory pressure at scale",
    r"\budf\(|pandas_udf|applyInPandas|mapInPandas|mapPartitions": "Python in the hot path",
}


def test_library_has_no_forbidden_calls():
    problems = []
    for path in sorted(LIB.rglob("*.py")):
        if "llm" in path.relative_to(LIB).parts:  # corpus operators have their own tests and styles
            continue
        for n, line in enumerate(path.read_text().splitlines(), 1):
            code = line.split("#", 1)[0]
            for pattern, why in FORBIDDEN.items():
                if re.search(pattern, code):
                    problems.append(f"{path.relative_to(LIB.parent)}:{n}: {why}: {line.strip()}")
    assert not problems, "\n".join(problems)
