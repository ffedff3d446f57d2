"""'::' text reader (A1) and the append-only similarity table."""

import pytest

from sparkrec.sources import delimited, sinks


def test_read_latin1_double_colon(spark, tmp_path):
    (tmp_path / "users.dat").write_bytes("1::F::1::10::48067\n2::M::56::16::70072-1234\n".encode("latin-1"))
    (tmp_path / "movies.dat").write_bytes("1::Caf\xe9 Society (1995)::Comedy|Drama\n".encode("latin-1"))
    (tmp_path / "ratings.dat").write_bytes("1::1::5::978300760\n2::1::3::978302109\n".encode("latin-1"))
    t = delimited.read_all(spark, str(tmp_path))
    assert t["movies"].first()["title"] == "Caf\xe9 Society (1995)"
    assert [r["zip_code"] for r in t["users"].orderBy("user_id").collect()] == ["48067", "70072-1234"]
    assert t["ratings"].count() == 2 and dict(t["ratings"].dtypes)["rating"] == "double"


def test_missing_input_file(spark, tmp_path):
    (tmp_path / "users.dat").write_text("1::F::1::10::48067\n")
    with pytest.raises(FileNotFoundError):
        delimited.read_all(spark, str(tmp_path))


def test_append_similarities(spark, tmp_path):
    rows = [(1, 2, 25, 0.5), (1, 3, 30, 0.25)]
    sims = spark.createDataFrame(rows, "item_id_1 long, item_id_2 long, common_users long, "
                                       "similarity_score double")
    path = str(tmp_path / "sims")
    sinks.append_similarities(spark, sims, path)
    more = spark.createDataFrame(rows + [(2, 3, 21, 0.75)], sims.schema)
    stored = sinks.append_similarities(spark, more, path)
    assert stored.count() == 3
    with pytest.raises(ValueError):
        sinks.append_similarities(spark, more, path, strict=True)


def test_a_batch_with_equal_pairs_is_stored_once(spark, tmp_path):
    import pytest
    from sparkrec.sources.sinks import append_similarities
    sims = spark.createDataFrame([(1, 2, 30, 0.5), (1, 2, 20, 0.4), (1, 3, 25, 0.1)],
                                 "item_id_1 long, item_id_2 long, common_users long, similarity_score double")
    with pytest.raises(ValueError, match="within the batch"):
        append_similarities(spark, sims, f"{tmp_path}/s", strict=True)
    for _ in range(2):
        got = append_similarities(spark, sims, f"{tmp_path}/t")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, 20, 0.4), (1, 3, 25, 0.1)]


def test_read_all_asks_the_file_system_of_the_path(spark, tmp_path):
    import pytest
    from sparkrec.sources.delimited import read_all
    for name, line in (("users", "1::F::1::10::00123"), ("movies", "1::A (1999)::Drama"), ("ratings", "1::1::4.5::978300760")):
        (tmp_path / f"{name}.dat").write_text(line + "\n", encoding="latin-1")
    assert read_all(spark, f"file:{tmp_path}")["ratings"].count() == 1
    with pytest.raises(FileNotFoundError, match="users.dat"):
        read_all(spark, f"file://{tmp_path}/none")
