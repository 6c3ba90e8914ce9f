"""Publishing by pointer: whole tables at any moment, on a store that can do very little."""

import posixpath
import threading

import pytest

from geoloom.sources import published


class Plain:
    """An object store in a dictionary: whole objects, never renamed or overwritten."""

    def __init__(self):
        self.objects, self.lock = {}, threading.Lock()

    def create(self, path, text):
        with self.lock:
            return path not in self.objects and self.objects.setdefault(path, text) == text

    def read(self, path):
        return self.objects[path]

    def names(self, folder):
        return sorted({posixpath.relpath(p, folder).split("/")[0] for p in list(self.objects) if p.startswith(folder + "/")})

    def delete(self, folder):
        for p in [p for p in self.objects if p.startswith(folder + "/")]:
            del self.objects[p]


def version(store, target, name):
    folder = posixpath.join(target, published.VERSIONS, name)
    store.create(f"{folder}/part-0", name)
    return folder


def test_a_store_without_renames():
    store, target = Plain(), "s3://bucket/table"
    assert published.current_version(store, target) is None
    folders = [version(store, target, n) for n in ("a", "b", "c", "d")]
    assert [published.publish(store, f, f"{target}/") for f in folders[:2]] == [1, 2]
    assert published.current_version(store, target) == folders[1]
    store.create(f"{target}/{published.POINTERS}/000000000003", "c")  # its writer crashed within the line
    assert published.current_version(store, target) == folders[1]
    assert published.publish(store, folders[3], target) == 4 and published.current_version(store, target) == folders[3]
    assert published.remove_old(store, target, keep=1) == 3 and store.names(f"{target}/{published.VERSIONS}") == ["d"]
    assert published.current_version(store, target) == folders[3] and published.remove_old(store, target) == 0
    for wrong in ("s3://bucket/other/x", f"{target}/{published.VERSIONS}/x/y", target):
        with pytest.raises(ValueError):
            published.publish(store, wrong, target)


def test_publishers_at_the_same_time_get_numbers_of_their_own():
    store, target, numbers = Plain(), "s3://bucket/table", []
    folders = [version(store, target, f"v{i}") for i in range(20)]
    threads = [threading.Thread(target=lambda f=f: numbers.append(published.publish(store, f, target))) for f in folders]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(numbers) == list(range(1, 21))


def test_readers_see_whole_tables_while_others_publish(spark, tmp_path):
    target, store = f"file://{tmp_path}/table", published.SparkStore(spark)
    with pytest.raises(ValueError, match="nothing was published"):
        published.read_published(spark, target)
    seen, failed, over = [], [], threading.Event()

    def reader():
        while not over.is_set():
            try:
                seen.append(sorted({r.v for r in published.read_published(spark, target).collect()}) + [published.read_published(spark, target).count()])
            except Exception as e:  # noqa: BLE001  any error fails the test below
                failed.append(e)

    def write(n):
        folder = published.fresh_version(target)
        spark.range(100 * n).selectExpr("id", f"{n} AS v").repartition(5).write.parquet(folder)
        return folder

    published.publish(store, write(1), target)
    thread = threading.Thread(target=reader)
    thread.start()
    for n in range(2, 6):
        folder = write(n)
        write(99)  # a version that is never published
        published.publish(store, folder, target)
    over.set()
    thread.join()
    assert not failed and seen and all(len(s) == 2 and s[1] % 100 == 0 and s[0] < 99 for s in seen)
    held = published.read_published(spark, target)
    assert held.count() == 500 and published.remove_old(store, target, keep=1) == 8
    assert published.read_published(spark, target).count() == 500 and not store.create(f"{target}/{published.POINTERS}/000000000001", "x\n")
