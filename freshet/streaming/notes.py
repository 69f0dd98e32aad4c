"""Small tables that grow by one note per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freshet.session import list_folder, path_exists, remove_folder

FOLD = 100


class Notes:
    """``{path}/single/{name}`` holds the note of one batch, ``{path}/folded/{name}`` those up to one.

    Names sort in the order of batches. A note that is written again replaces itself. A
    reader takes the last folder of folded notes and the single ones after it; folders
    that a lost writer left unfinished have no ``_SUCCESS`` file and are passed over. What
    has been folded is deleted at the next folding, so that readers have time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def _finished(self, kind: str) -> dict[str, str]:
        """Folders of finished notes by name, in order."""
        base = f"{self.path}/{kind}"
        folders = list_folder(self.spark, base) if path_exists(self.spark, base) else []
        done = (folder for folder in folders if path_exists(self.spark, f"{folder}/_SUCCESS"))
        return {folder.rsplit("/", 1)[-1]: folder for folder in sorted(done)}

    def write(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/single/{name}")

    def read(self) -> DataFrame:
        folded = list(self._finished("folded").items())[-1:]
        last = folded[0][0] if folded else ""
        singles = [folder for name, folder in self._finished("single").items() if name > last]
        folders = [folder for _, folder in folded] + singles
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def fold(self, merge: Callable[[DataFrame], DataFrame], every: int = FOLD) -> None:
        """Once ``every`` single notes have come since the last time, write all as one."""
        folded, singles = self._finished("folded"), self._finished("single")
        last = max(folded, default="")
        news = [name for name in singles if name > last]
        if len(news) < every:
            return
        merge(self.read()).write.parquet(f"{self.path}/folded/{news[-1]}")
        for name, folder in folded.items():
            if name < last:
                remove_folder(self.spark, folder)
        for name, folder in singles.items():
            if name <= last:
                remove_folder(self.spark, folder)
