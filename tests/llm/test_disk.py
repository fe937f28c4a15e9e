"""What operators and stages leave on disk while their result is still to be read."""

import os
import subprocess
import sys

from conftest import SF_DIR

import corpus_pipeline
from lossloom import session as S
from lossloom.llm import paragraphs, simhash


def folders(spark):
    return set(os.listdir(S.checkpoint_root(spark).removeprefix("file:")))


def test_operators_leave_only_what_their_result_reads(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    S.materialise(spark.range(1))
    for run, most in ((lambda: paragraphs.drop_repeated(docs), 2), (lambda: simhash.near_duplicates(docs), 2),
                      (lambda: corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR), 2), (lambda: corpus_pipeline.mix_sources(spark, docs, SF_DIR), 2)):
        before = folders(spark)
        with S.scratch(spark):
            found = run()
            assert 0 < len(folders(spark) - before) <= most
            assert found.count() > 0
        assert folders(spark) == before


def test_nested_trimmed_calls_keep_earlier_tables(spark):
    @S.trimmed
    def inner(df):
        S.materialise(df)
        return S.materialise(df.filter("id > 1"))

    @S.trimmed
    def outer(df):
        first = S.materialise(df)
        return first.join(inner(first), "id")

    given = S.materialise(spark.range(5))
    with S.scratch(spark):
        assert outer(given).count() == 3
    assert given.count() == 5


def test_shuffle_files_end_with_the_write(tmp_path):
    code = ("import sys; sys.path.insert(0, sys.argv[1])\nfrom lossloom.session import build_session, materialise, SHUFFLES_GO\nimport glob, time\n"
            "s = build_session('end', 'local[1]', **{'spark.ui.enabled': 'false', 'spark.local.dir': sys.argv[2], 'spark.checkpoint.dir': sys.argv[2] + '/cp'})\n"
            "t = materialise(s.range(1000).repartition(3))\n"
            "for _ in range(50):\n    left = glob.glob(sys.argv[2] + '/**/shuffle_*', recursive=True)\n    if not left: break\n    time.sleep(0.1)\n"
            "print(t.count(), len(left), s.conf.get(SHUFFLES_GO, None)); s.stop()")
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code, here, str(tmp_path)], capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("1000 0 None")
