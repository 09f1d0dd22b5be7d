"""The build in a session that sets neither zone nor ANSI mode, in a process of its own."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code: str, **environment: str) -> str:
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)],
        cwd=ROOT, env=os.environ | environment, capture_output=True, text=True, timeout=600, check=False,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_the_warehouse_is_built_in_a_session_without_settings():
    out = _run(
        """
        from pyspark.sql import SparkSession
        builder = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
        spark = builder.config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1").getOrCreate()
        import __spark_entry__ as entry
        result = entry.queries()["q_build_warehouse"](spark, "/root/testdata/sf0.001")
        print("models", result.count())
        """,
        TZ="UTC",
    )
    assert "models 13" in out


def test_other_settings_are_refused():
    out = _run(
        """
        from pyspark.sql import SparkSession
        builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
        spark = builder.config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1").getOrCreate()
        from dimspark.session import require_settings
        require_settings(spark)
        for key, value in (("spark.sql.session.timeZone", "Europe/Paris"), ("spark.sql.ansi.enabled", "false")):
            before = spark.conf.get(key)
            spark.conf.set(key, value)
            try:
                require_settings(spark)
                print("accepted", key)
            except ValueError:
                print("refused", key)
            spark.conf.set(key, before)
        """,
        TZ="UTC",
    )
    assert out.count("refused") == 2 and "accepted" not in out
