"""Job entry points run end to end on small inputs."""

import json
import os

from conftest import rows

from ratinglens import cli
from ratinglens.streaming import speed


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_build_job_from_text(spark, tmp_dir, capsys):
    _write(
        f"{tmp_dir}/players/p.csv",
        "fide_id,name,federation,gender,title,yob\n"
        '1,"Doe, Ann",USA,F,GM,1990\n'
        '2,"Roe, Bob",USA,M,\\N,1980\n',
    )
    _write(
        f"{tmp_dir}/ratings/r.csv",
        "fide_id,year,month,rating_standard,rating_rapid,rating_blitz\n"
        "1,2016,1,2500,2400,2300\n1,2016,2,2501,2400,\\N\n2,2016,1,2000,1900,1800\n"
        "1,2016,1,2500,2400,2300\n",  # duplicate row: one history row remains, both count in the averages
    )
    cli.main(["build", "--players", f"{tmp_dir}/players", "--ratings", f"{tmp_dir}/ratings",
              "--dst", f"{tmp_dir}/views", "--raw-names"])
    paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    fed = spark.read.parquet(paths["fed_by_year"]).collect()
    assert [(r.federation, r.year, r.rating_standard, r.rating_blitz) for r in fed] == [("USA", 2016, 2375, 2133)]  # averages are over all rows
    assert spark.read.parquet(paths["history"]).count() == 3
    assert rows(spark.read.parquet(paths["id_name"]), "name_key") == [("Ann_Doe_1",), ("Bob_Roe_2",)]


def test_files_speed_job_once(spark, tmp_dir):
    msgs = [
        {"seq": i, "ts": "2024-01-01T00:00:%02d" % i,
         "value": json.dumps({"fide_id": str(i % 2), "first_name": "a", "last_name": "b",
                              "rating_standard": str(100 + i), "rating_rapid": "1", "rating_blitz": "2"})}
        for i in range(5)
    ]
    _write(f"{tmp_dir}/in/m.json", "\n".join(json.dumps(m) for m in msgs) + "\n")
    cli.main(["files", "--source", f"{tmp_dir}/in", "--views", f"{tmp_dir}/view",
              "--checkpoint", f"{tmp_dir}/ckpt", "--once"])
    for q in spark.streams.active:
        q.awaitTermination(60)
    got = {r.fide_id: (r.rating_standard, r.stream_count) for r in speed.read_speed_state(spark, f"{tmp_dir}/view").collect()}
    assert got == {"0": ("104", 3), "1": ("103", 2)}
