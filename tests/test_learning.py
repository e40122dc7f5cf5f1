import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from varve.functions import classify, images
from varve.operators import evaluation, gradients, sharding
from varve.plans.training import progress_lines, train_softmax
from varve.plans.wide_training import train_softmax_wide

CLASSES, WIDTH = 3, 4


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    label = rng.integers(0, CLASSES, 53)
    features = rng.normal(size=(53, WIDTH)).round(3) + np.eye(CLASSES, WIDTH)[label]
    return features, label


@pytest.fixture(scope="module")
def examples(spark, data):
    rows = [(i, [float(v) for v in x], int(y)) for i, (x, y) in enumerate(zip(*data))]
    return spark.createDataFrame(rows, "id bigint, features array<double>, label int")


def gradient(model, x, y):
    scores = x @ model.weight.T + model.bias
    p = np.exp(scores - scores.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    return p.T @ x / len(y), p.mean(0)


def small_model():
    return gradients.LinearModel(np.arange(12).reshape(3, 4) / 10 - 0.5, np.array([0.1, 0.0, -0.1]))


def test_shards_are_equal_cover_all_and_repeat(examples):
    rows = sharding.assign_shards(examples, 4).collect()
    assert len(rows) == 56
    assert {r["id"] for r in rows} == set(range(53))
    assert [sum(r["shard"] == s for r in rows) for s in range(4)] == [14] * 4
    again = sharding.assign_shards(examples, 4).collect()
    key = lambda r: (r["position"], r["id"], r["shard"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    other = sharding.assign_shards(examples, 4, epoch=1).collect()
    assert sorted(map(key, rows)) != sorted(map(key, other))


def test_more_shards_than_rows(examples):
    rows = sharding.assign_shards(examples.where("id < 3"), 8).collect()
    assert sorted(r["shard"] for r in rows) == list(range(8))
    assert {r["id"] for r in rows} == {0, 1, 2}


def test_batches_fill_each_shard(examples):
    rows = sharding.assign_batches(examples, 4, 20).collect()
    sizes = {}
    for r in rows:
        sizes[r["shard"], r["batch"]] = sizes.get((r["shard"], r["batch"]), 0) + 1
    assert sizes == {(s, b): n for s in range(4) for b, n in ((0, 5), (1, 5), (2, 4))}


def test_gradient_averages_agree_with_the_whole_batch(examples, data):
    sharded = sharding.assign_shards(examples.where("id < 52"), 4)
    model = small_model()
    local = gradients.shard_gradients(sharded, model).where(F.col("param").isin("weight", "bias"))
    want_w, want_b = gradient(model, data[0][:52], data[1][:52])
    reduced = {(r["param"], r["pos"]): r["value"] for r in gradients.gradient_mean_allreduce(local, 4).collect()}
    assert [reduced["weight", i] for i in range(12)] == pytest.approx(want_w.reshape(-1))
    assert [reduced["bias", i] for i in range(3)] == pytest.approx(want_b)
    gathered = gradients.gradient_mean_gather(local).collect()
    assert len(gathered) == 4 * 15
    assert all(r["value"] == pytest.approx(reduced[r["param"], r["pos"]]) for r in gathered)


def test_sgd_step(spark):
    params = spark.createDataFrame([("weight", 0, 2.0, 0.5)], "param string, pos int, value double, velocity double")
    grads = spark.createDataFrame([("weight", 0, 0.25)], "param string, pos int, value double")
    row = gradients.sgd_update(params, grads).first()
    velocity = 0.9 * 0.5 + 0.25 + 1e-4 * 2.0
    assert (row["velocity"], row["value"]) == pytest.approx((velocity, 2.0 - 0.1 * velocity))


@pytest.mark.parametrize("sync", ["gather", "allreduce"])
def test_training_follows_plain_sgd(examples, data, sync):
    run = train_softmax(examples, CLASSES, WIDTH, shards=2, global_batch=16, epochs=2, sync=sync, report_every=2)
    order = []
    for epoch in range(2):
        rows = sharding.assign_batches(examples, 2, 16, epoch=epoch).collect()
        order += [[r["id"] for r in rows if r["batch"] == b] for b in range(4)]
    model = gradients.LinearModel.zeros(CLASSES, WIDTH)
    vel_w, vel_b = np.zeros((CLASSES, WIDTH)), np.zeros(CLASSES)
    for ids in order:
        g_w, g_b = gradient(model, data[0][ids], data[1][ids])
        vel_w = 0.9 * vel_w + g_w + 1e-4 * model.weight
        vel_b = 0.9 * vel_b + g_b + 1e-4 * model.bias
        model = gradients.LinearModel(model.weight - 0.1 * vel_w, model.bias - 0.1 * vel_b)
    assert np.allclose(run.model.weight, model.weight) and np.allclose(run.model.bias, model.bias)
    progress = run.progress.orderBy("epoch", "batch").collect()
    assert [(r["epoch"], r["batch"], r["rows_seen"], r["percent"]) for r in progress] == [
        (0, 0, 0, 0.0), (0, 2, 32, 50.0), (1, 0, 0, 0.0), (1, 2, 32, 50.0)
    ]
    assert progress[0]["loss"] == pytest.approx(np.log(CLASSES))
    line = progress_lines(run.progress).first()["line"]
    assert line == "Train Epoch: 0 [0/53 (0%)]\tLoss: 1.098612"


def test_scores_and_evaluation(examples, data):
    model = small_model()
    scores = data[0] @ model.weight.T + model.bias
    batched = sharding.ordered_batches(examples, 10)
    scored = gradients.linear_scores(batched, model)
    loss = np.log(np.exp(scores).sum(1)) - scores[np.arange(53), data[1]]
    by_row = evaluation.evaluate(scored).first()
    assert by_row["loss"] == pytest.approx(loss.mean())
    assert by_row["correct"] == int((scores.argmax(1) == data[1]).sum()) and by_row["total"] == 53
    by_batch = evaluation.evaluate_batches(scored).first()
    assert by_batch["loss"] == pytest.approx(np.mean([loss[i:i + 10].mean() for i in range(0, 53, 10)]))
    assert by_batch["loss"] != pytest.approx(by_row["loss"])


def test_uneven_features_are_refused(spark):
    bad = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<double>")
    with pytest.raises(Exception, match="must have 4 values"):
        gradients.linear_scores(bad, small_model()).collect()


def test_row_classification(spark):
    row = spark.sql("SELECT array(1.0D, 3.0D, 3.0D) AS s, 0 AS label").select(
        classify.argmax(F.col("s")), classify.cross_entropy(F.col("s"), F.col("label"))
    ).first()
    assert row[0] == 1
    assert row[1] == pytest.approx(np.log(np.exp([1, 3, 3]).sum()) - 1)


def test_image_expressions(spark):
    flat = spark.range(1).select(F.expr("transform(sequence(0, 11), x -> cast(x as double))").alias("v"))
    grid = flat.select(images.to_grid(F.col("v"), 3, 2, 2).alias("image"))
    pixels = np.arange(12.0).reshape(3, 2, 2)
    assert np.allclose(grid.first()[0], pixels)
    mean, std = np.array(images.CHANNEL_MEAN), np.array(images.CHANNEL_STD)
    want = (pixels / 255 - mean[:, None, None] / 255) / (std[:, None, None] / 255)
    assert np.allclose(grid.select(images.normalize(F.col("image"))).first()[0], want)
    assert np.allclose(grid.select(images.flip(F.col("image"), F.lit(True))).first()[0], pixels[:, :, ::-1])
    padded = np.pad(pixels, ((0, 0), (4, 4), (4, 4)))
    for top, left in ((0, 0), (4, 4), (3, 5), (8, 8)):
        got = grid.select(images.crop(F.col("image"), F.lit(top), F.lit(left), 2, 2)).first()[0]
        assert np.allclose(got, padded[:, top:top + 2, left:left + 2])
    draws = [r[0] for r in spark.range(400).select(images.draw(9, 1, F.col("id").cast("string"))).collect()]
    assert set(draws) == set(range(9))


def test_parameters_without_gradient_stay(spark):
    params = spark.createDataFrame(
        [("weight", 0, 2.0, 0.5), ("weight", 1, 3.0, 0.25)], "param string, pos int, value double, velocity double"
    )
    grads = spark.createDataFrame([("weight", 0, 0.1), ("loss", 0, 9.0)], "param string, pos int, value double")
    rows = {(r["param"], r["pos"]): r for r in gradients.sgd_update(params, grads).collect()}
    assert rows.keys() == {("weight", 0), ("weight", 1), ("loss", 0)}
    assert (rows["weight", 1]["value"], rows["weight", 1]["velocity"]) == (3.0, 0.25)
    assert rows["loss", 0]["value"] is None and rows["loss", 0]["gradient"] == 9.0


def test_more_shards_than_batch_rows_are_refused():
    with pytest.raises(ValueError):
        sharding.batch_size(300, 256)


def test_exact_gradients_equal_exact_fractions(spark, examples, data):
    from fractions import Fraction

    model = small_model()
    sharded = examples.withColumn("shard", (F.col("id") % 2).cast("int"))
    got = {(r["shard"], r["param"], r["pos"]): r["value"] for r in gradients.shard_gradients(sharded, model, exact=True).collect()}
    features, label = data
    for shard in (0, 1):
        x, y = features[shard::2], label[shard::2]
        error, loss = gradients._errors(model.scores(x, exact=True), y)
        for c in range(CLASSES):
            for f in range(WIDTH):
                total = float(sum(Fraction(e * v) for e, v in zip(error[:, c], x[:, f])))
                assert got[shard, "weight", c * WIDTH + f] == total / len(y)
            assert got[shard, "bias", c] == float(sum(map(Fraction, error[:, c]))) / len(y)
        assert got[shard, "rows", 0] == len(y)
        assert got[shard, "loss", 0] == float(sum(map(Fraction, loss))) / len(y)


def test_exact_models_are_the_same_bit_for_bit(spark, examples):
    models = []
    for parts, sync in ((1, "allreduce"), (7, "allreduce"), (3, "gather")):
        mixed = examples.repartition(parts, F.rand(parts))
        run = train_softmax(mixed, CLASSES, WIDTH, shards=3, global_batch=30, epochs=2, sync=sync, exact=True)
        models.append((run.model.weight.tolist(), run.model.bias.tolist(), [tuple(r) for r in run.progress.collect()]))
    assert models[0] == models[1] == models[2]
    plain = train_softmax(examples, CLASSES, WIDTH, shards=3, global_batch=30, epochs=2).model
    assert np.allclose(plain.weight, models[0][0], atol=1e-12)


def test_exact_evaluation(spark, examples):
    seen = set()
    for parts in (1, 2, 9):
        scored = gradients.linear_scores(examples.repartition(parts, F.rand(parts)), small_model(), exact=True)
        batched = scored.withColumn("batch", F.floor(F.col("id") / 10))
        seen.add((tuple(evaluation.evaluate(scored, exact=True).first()), tuple(evaluation.evaluate_batches(batched, exact=True).first())))
    assert len(seen) == 1
    (one, two), = seen
    assert one == pytest.approx(tuple(evaluation.evaluate(scored).first()))
    assert two == pytest.approx(tuple(evaluation.evaluate_batches(batched).first()))


def test_permuted_epochs_train_on_every_row(spark, examples, monkeypatch):
    from varve.plans import training

    seen = []
    batches = training.assign_batches_permuted
    monkeypatch.setattr(training, "assign_batches_permuted", lambda *a: seen.append(batches(*a)) or seen[-1])
    run = train_softmax(examples, CLASSES, WIDTH, shards=2, global_batch=20, epochs=2, reshuffle="permute")
    orders = [[r["id"] for r in df.orderBy("position").collect()] for df in seen]
    assert len(orders) == 2 and orders[0] != orders[1]
    assert all(set(o) == set(range(53)) and len(o) == 54 for o in orders)
    sorted_run = train_softmax(examples, CLASSES, WIDTH, shards=2, global_batch=20, epochs=2)
    assert np.abs(run.model.weight - sorted_run.model.weight).max() < 0.5


@pytest.mark.parametrize("width", [1, 3, 4, None])
def test_wide_models_equal_shipped_ones(spark, examples, width):
    how = {"shards": 3, "global_batch": 30, "epochs": 1}
    model = train_softmax(examples, CLASSES, WIDTH, **how)
    want = {(r["param"], r["pos"]): (r["value"], r["velocity"]) for r in model.params.collect()}
    rows = train_softmax_wide(examples, CLASSES, WIDTH, block_features=width, **how).collect()
    assert len(rows) == CLASSES * WIDTH + CLASSES
    for r in rows:
        assert (r["value"], r["velocity"]) == pytest.approx(want[r["param"], r["pos"]], abs=1e-12)


def test_wide_models_have_no_bound(spark, examples, monkeypatch):
    monkeypatch.setattr(gradients, "MODEL_VALUES_MAX", 5)
    with pytest.raises(ValueError):
        train_softmax(examples, CLASSES, WIDTH)
    assert train_softmax_wide(examples, CLASSES, WIDTH, block_features=2, global_batch=60).count() == 15


def test_steps_are_as_wide_as_the_model_needs(spark, examples, monkeypatch):
    from varve.plans import training, wide_training
    from varve.session import shuffle_width

    seen = []
    for module in (training, wide_training):
        monkeypatch.setattr(module, "shuffle_width", lambda s, n: seen.append(n) or shuffle_width(s, n))
    train_softmax(examples, CLASSES, WIDTH, shards=2, global_batch=40)
    train_softmax_wide(examples, CLASSES, WIDTH, block_features=3, shards=2, global_batch=40)
    assert seen == [1, 1, 1, 1]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert training.step_width(spark, 10**12) == width > training.step_width(spark, 2 * training.STEP_VALUES) == 2


def test_a_step_opens_the_files_of_few_rows(spark, monkeypatch):
    from varve.plans import training

    written, made = training.written, []
    monkeypatch.setattr(training, "written", lambda *a: made.append(written(*a)) or made[-1])
    rows = spark.range(12_000).select("id", F.array(F.col("id") % 2 * 1.0).alias("features"), (F.col("id") % 2).cast("int").alias("label"))
    train_softmax(rows, 2, 1, shards=2, global_batch=3_000)
    assert made[0].groupBy("slab").count().agg(F.max("count")).first()[0] <= 6_000


def test_exact_sums_are_built_once_for_all_steps(spark, examples, monkeypatch):
    from varve.functions import exact

    train_softmax(examples, CLASSES, WIDTH, shards=2, global_batch=40, exact=True)
    monkeypatch.setattr(exact, "from_limbs", lambda sums: pytest.fail("built again"))
    train_softmax(examples, CLASSES, WIDTH, shards=2, global_batch=40, exact=True)


def by_key(rows, *keys):
    rows = rows.to_pylist() if hasattr(rows, "to_pylist") else [r.asDict() for r in rows.collect()]
    return {tuple(r[k] for k in keys): [v for c, v in sorted(r.items()) if c not in keys] for r in rows}


def alike(found, wanted, exact):
    assert found.keys() == wanted.keys()
    for key, values in wanted.items():
        assert found[key] == (values if exact else [v if v is None else pytest.approx(v, abs=1e-14) for v in values])


@pytest.mark.parametrize("exact", [False, True])
def test_operators_of_a_step_give_tables_the_same_rows(spark, examples, exact):
    model = small_model()
    frame = examples.withColumn("shard", (F.col("id") % 3).cast("int"))
    table = frame.toArrow()
    local, local_table = gradients.shard_gradients(frame, model, exact), gradients.shard_gradients(table, model, exact)
    alike(by_key(local_table, "shard", "param", "pos"), by_key(local, "shard", "param", "pos"), exact)
    gathered, gathered_table = gradients.gradient_mean_gather(local, exact), gradients.gradient_mean_gather(local_table, exact)
    alike(by_key(gathered_table, "shard", "param", "pos"), by_key(gathered, "shard", "param", "pos"), exact)
    alike(by_key(gradients.first_copy(gathered_table), "param", "pos"), by_key(gradients.first_copy(gathered), "param", "pos"), exact)
    mean, mean_table = gradients.gradient_mean_allreduce(local, 3, exact), gradients.gradient_mean_allreduce(local_table, 3, exact)
    alike(by_key(mean_table, "param", "pos"), by_key(mean, "param", "pos"), exact)
    params = spark.createDataFrame(model.to_rows()).withColumn("velocity", F.col("pos") / 8)
    # one parameter has no gradient, and loss and rows have no parameter
    some, some_table = mean.where("param != 'bias' or pos > 0"), mean_table.filter((pc.field("param") != "bias") | (pc.field("pos") > 0))
    alike(by_key(gradients.sgd_update(params.toArrow(), some_table), "param", "pos"), by_key(gradients.sgd_update(params, some), "param", "pos"), exact)


def trained(examples, monkeypatch, **how):
    """What comes of training in runs of steps and in a job a step, with the number of their jobs."""
    from varve.plans import training
    from varve.session import shuffle_width

    made = []
    for products in (training.TASK_PRODUCTS, 0):
        jobs = []
        monkeypatch.setattr(training, "TASK_PRODUCTS", products)
        monkeypatch.setattr(training, "shuffle_width", lambda s, n: jobs.append(n) or shuffle_width(s, n))
        run = train_softmax(examples, CLASSES, WIDTH, **how)
        made.append((by_key(run.params, "param", "pos"), by_key(run.progress, "epoch", "batch"), len(jobs)))
    return made


@pytest.mark.parametrize("sync", ["gather", "allreduce"])
def test_exact_runs_of_steps_equal_a_job_a_step(examples, monkeypatch, sync):
    how = {"shards": 2, "global_batch": 10, "sync": sync, "exact": True, "report_every": 4}
    runs, steps = trained(examples, monkeypatch, **how)
    assert runs[:2] == steps[:2]
    assert (runs[2], steps[2]) == (2, 6)


def test_progress_of_runs_equals_that_of_a_job_a_step(examples, monkeypatch):
    how = {"shards": 2, "global_batch": 8, "epochs": 2, "report_every": 3}
    runs, steps = trained(examples, monkeypatch, **how)
    # seven steps an epoch: the last to report is one, and no run goes into the next epoch
    assert list(runs[1]) == [(e, b) for e in (0, 1) for b in (0, 3, 6)]
    alike(runs[0], steps[0], False)
    alike(runs[1], steps[1], False)
    assert (runs[2], steps[2]) == (2, 14)


def test_runs_of_steps_follow_each_other_and_end_with_a_report():
    from varve.plans.training import step_runs

    assert list(step_runs(7, 3, 5)) == [(0, 1), (1, 4), (4, 6), (6, 7)]
    assert list(step_runs(0, 3, 5)) == []
    for steps, most, every in ((40, 7, 3), (41, 1, 20), (100, 78, 3), (57, 19, 20)):
        runs = list(step_runs(steps, most, every))
        assert [s for first, end in runs for s in range(first, end)] == list(range(steps))
        assert max(end - first for first, end in runs) <= most


def test_a_run_takes_batches_in_any_pieces_and_misses_none(data):
    from varve.plans import training

    x, y = data[0][:48], data[1][:48]
    columns = {"batch": np.arange(48) // 8, "shard": np.arange(48, dtype=np.int32) % 2, "features": x.tolist(), "label": y}
    rows = pa.table(columns).combine_chunks()
    model = gradients.LinearModel.zeros(CLASSES, WIDTH)
    state = model.to_rows().append_column("velocity", pa.array([0.0] * 15))

    def run(table, size, end=6):
        made = training._run(state, model, 0, end, 3, 2, "allreduce", True, 0.1, 0.9, 1e-4)(table.to_batches(size))
        return pa.Table.from_batches(list(made)).to_pylist()

    whole = run(rows, 48)
    assert len(whole) == 15 + 2 * 2 and {r["step"] for r in whole if r["value"] is None} == {0, 3}
    for size in (1, 3, 8, 13):
        assert run(rows, size) == whole
    for cut, end in ((rows.slice(8), 6), (rows.slice(0, 40), 6), (pa.concat_tables([rows.slice(0, 8), rows.slice(16)]), 6), (rows, 5)):
        with pytest.raises(ValueError, match="is missing"):
            run(cut, 48, end)


def test_report_lines_of_runs(spark, examples, data, monkeypatch):
    from varve.plans import training
    from varve.session import shuffle_width

    jobs = []
    monkeypatch.setattr(training, "shuffle_width", lambda s, n: jobs.append(n) or shuffle_width(s, n))
    run = train_softmax(examples, CLASSES, WIDTH, shards=2, global_batch=6, report_every=2)
    assert len(jobs) == 1  # nine steps
    rows, model = sharding.assign_batches(examples, 2, 6).collect(), gradients.LinearModel.zeros(CLASSES, WIDTH)
    velocity, lines = [np.zeros((CLASSES, WIDTH)), np.zeros(CLASSES)], []
    for step in range(9):
        ids = [r["id"] for r in rows if r["batch"] == step]
        x, y = data[0][ids], data[1][ids]
        if step % 2 == 0:
            loss = gradients._errors(model.scores(x), y)[1].mean()
            lines.append(f"Train Epoch: 0 [{step * len(ids)}/53 ({100 * step / 9:.0f}%)]\tLoss: {loss:.6f}")
        grown = zip(velocity, gradient(model, x, y), (model.weight, model.bias))
        velocity = [0.9 * v + g + 1e-4 * w for v, g, w in grown]
        model = gradients.LinearModel(model.weight - 0.1 * velocity[0], model.bias - 0.1 * velocity[1])
    assert [r["line"] for r in progress_lines(run.progress.orderBy("batch")).collect()] == lines
