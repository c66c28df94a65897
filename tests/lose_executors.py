"""python tests/lose_executors.py QUERY...: runs queries on three local executors, then again while one is killed every three
seconds, and compares the results. By hand, not by pytest: it needs a minute and kills processes of its own."""

import importlib.util
import os
import sys
import tempfile
import threading
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def main(names: list[str], data: str) -> None:
    import psutil
    from pyspark.sql import SparkSession

    d = Path(tempfile.mkdtemp(prefix="spark-"))
    (d / "home/work").mkdir(parents=True)
    for p in Path(importlib.util.find_spec("pyspark").origin).parent.iterdir():  # executors log to work in Spark's home
        if p.name != "work":
            (d / "home" / p.name).symlink_to(p)
    os.environ |= {"SPARK_SCALA_VERSION": "2.13", "SPARK_HOME": str(d / "home"), "SPARK_LOCAL_DIRS": str(d / "local"), "PYSPARK_PYTHON": sys.executable}
    conf = {
        "spark.master": "local-cluster[3,2,2400]", "spark.executor.memory": "1500m", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1",
        "spark.sql.shuffle.partitions": "12", "spark.sql.files.maxPartitionBytes": "1m", "spark.checkpoint.dir": f"file://{d}/shared", "spark.sql.session.timeZone": "UTC",
    }
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    import __spark_entry__

    known, killed = __spark_entry__.queries(), []

    def kill(stop: threading.Event) -> None:
        while not stop.wait(3):
            own = [p for p in psutil.Process().children(recursive=True) if p.name() == "java" and "CoarseGrainedExecutorBackend" in " ".join(p.cmdline())]
            if len(own) > 1:
                own[0].kill()
                killed.append(own[0].pid)

    for name in names:
        run = lambda: sorted(map(tuple, known[name](spark, data).collect()), key=repr)  # noqa: B023, E731
        calm, before, stop = run(), len(killed), threading.Event()
        thread = threading.Thread(target=kill, args=(stop,))
        thread.start()
        began = time.time()
        again = run()
        stop.set()
        thread.join()
        print(f"{name}: {len(calm)} rows, same with {len(killed) - before} executors killed: {calm == again}, {time.time() - began:.0f} s", flush=True)
    os._exit(0)


if __name__ == "__main__":
    main(sys.argv[1:], os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
