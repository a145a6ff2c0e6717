import json

from rankloom.sources import readers, writers


def put(folder, name, lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_graph_inputs(spark, tmp_path):
    path = put(tmp_path, "links.txt", ["1 2 1", "1 2 2", "", "3 1 1"])
    assert rows(readers.read_edges(spark, path)) == [(1, 2, 3.0), (3, 1, 1.0)]
    assert rows(readers.read_doc_topics(spark, put(tmp_path, "t.txt", ["5 1", "6 12"]))) == [(5, 1), (6, 12)]


def test_mixture_uses_the_position(spark, tmp_path):
    path = put(tmp_path, "mix.txt", ["2 1 1:0.25 9:0.75", "3 4 1:1 2:0"])
    assert rows(readers.read_topic_mixture(spark, path)) == [(2, 1, 1, 0.25), (2, 1, 2, 0.75), (3, 4, 1, 1.0), (3, 4, 2, 0.0)]


def test_run_folder_takes_the_list_from_the_file_name(spark, tmp_path):
    put(tmp_path / "runs", "12-1.results.txt", ["0 Q0 22401 1 -3.35 search", "0 Q0 7 2 -4.5 search"])
    put(tmp_path / "runs", "2-5.results.txt", ["0 Q0 9 1 -inf search".replace("-inf", "-Infinity")])
    got = rows(readers.read_run_dir(spark, str(tmp_path / "runs")))
    assert got == [(2, 5, 9, 1, float("-inf")), (12, 1, 7, 2, -4.5), (12, 1, 22401, 1, -3.35)]


def test_rating_inputs(spark, tmp_path):
    path = put(tmp_path, "train.csv", ["10,1,5,2005-09-06", "10,1,4,2005-09-07", "11,2,3,2004-01-01"])
    centred = readers.read_ratings(spark, path)
    assert rows(centred) == [(10, 1, 1.0), (10, 1, 2.0), (11, 2, 0.0)]
    assert rows(readers.read_ratings_raw(spark, path))[0] == (10, 1, 4.0)
    assert rows(readers.rating_matrix(centred)) == [(1, 10, 3.0), (2, 11, 0.0)]
    profiles = readers.read_profiles(spark, put(tmp_path, "dev.queries", ["1 10:5 11:3", "2 11:1"]))
    assert rows(profiles) == [(1, 10, 2.0), (2, 11, -2.0)]


def test_targets_keep_the_file_order(spark, tmp_path):
    pairs = [(i * 7 % 50, i) for i in range(200)]
    path = put(tmp_path, "dev.csv", [f"{a},{b}" for a, b in pairs])
    got = readers.read_targets(spark, path).orderBy("pair_idx").collect()
    assert [(r.pair_idx, r.item_id, r.user_id) for r in got] == [(i + 1, a, b) for i, (a, b) in enumerate(pairs)]


def test_labelled_tree_and_vectors(spark, tmp_path):
    put(tmp_path / "train/positive", "a.txt", ["good", "fine"])
    put(tmp_path / "train/negative", "b.txt", ["bad"])
    assert rows(readers.read_labelled_tree(spark, str(tmp_path / "train"))) == [("neg", "bad"), ("pos", "fine"), ("pos", "good")]
    path = put(tmp_path, "vec.txt", ["2 3", "cat 1.5 2 -3", "dog 1 2"])
    assert rows(readers.read_vectors(spark, path, 3)) == [("cat", [1.5, 2.0, -3.0])]


def test_reviews_without_stars(spark, tmp_path):
    lines = [json.dumps({"review_id": "a", "text": "x", "stars": 4}), json.dumps({"review_id": "b", "text": "y"})]
    assert rows(readers.read_reviews(spark, put(tmp_path, "r.json", lines))) == [("a", "x", 4), ("b", "y", 0)]
    assert rows(readers.read_stopwords(spark, put(tmp_path, "s.txt", [" the ", "a", "the"]))) == [("a",), ("the",)]


def test_libsvm_keeps_zero_based_indexes_and_empty_rows(spark, tmp_path):
    labels = spark.createDataFrame([(0, 5), (1, 0)], "row_id long, label int")
    features = spark.createDataFrame([(0, 3, 1.0), (0, 0, 2.0)], "row_id long, idx int, val double")
    assert [r.value for r in writers.libsvm_lines(labels, features).orderBy("row_id").collect()] == ["5 0:2.0 3:1.0", "0"]
    writers.write_libsvm(labels, features, str(tmp_path / "out"))
    got_labels, got = readers.read_libsvm(spark, str(tmp_path / "out"))
    assert sorted(r.label for r in got_labels.collect()) == [0.0, 5.0]
    assert sorted((r.idx, r.val) for r in got.collect()) == [(0, 2.0), (3, 1.0)]


def test_written_lines(spark, tmp_path):
    ranked = spark.createDataFrame([(2, 1, 9, 1, 0.5)], "user_id int, query_id int, doc long, position long, score double")
    assert writers.run_lines(ranked, "me").first().value == "2-1 Q0 9 1 0.5 me"
    writers.write_run(ranked, str(tmp_path / "run"))
    assert rows(readers.read_ranked_run(spark, str(tmp_path / "run"))) == [(2, 1, 9, 1, 0.5)]
    stars = spark.createDataFrame([(0, 3, 2.5)], "row_id long, hard int, soft double")
    assert writers.hard_soft_lines(stars).first().value == "3 2.5"
    assert writers.prediction_name("user", "dev", "cosine", "mean", 10) == "user_dev_cosine_mean_10.txt"
    scores = spark.createDataFrame([(7, 0.25)], "id long, score double")
    assert writers.score_lines(scores).first().value == "7 0.25"


def test_csv_keeps_quotes_and_blanks(spark, tmp_path):
    docs = spark.createDataFrame([("pos", ' say "hi", now '), ("neg", "x")], "label string, text string")
    writers.write_text_csv(docs, str(tmp_path / "csv"))
    assert rows(readers.read_text_csv(spark, str(tmp_path / "csv"))) == rows(docs)
