"""What a folder of tables holds: a manifest per publication, read before any data.

A delivery is written into version folders no reader looks at; one small manifest, put in place
last, makes all its tables visible together. So a job that stops half-way leaves what was
published before, and a delivery is replaced without deleting what readers hold open. The
manifests are also the ledger of what was served: source, arrival, its time and a digest of its
content. They grow with the deliveries, by a few lines each, not with the rows.

    <root>/<table>/version=<v>/delivery_day=<day>/operating_day=<day>/*.parquet
    <root>/_deliveries/<number>-<v>.json    a line per delivery day and publication
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER, VERSION, DELIVERY = "_deliveries", "version", "delivery_day"
REJECTED, ACCOUNTS = "rejected", "accounts"  # come with every publication, beside its tables
LINES = """delivery_day string, number bigint, tables map<string, string>, rows map<string, bigint>,
    source string, arrival string, arrived_at double, digest string"""


@dataclass(frozen=True)
class Publication:
    """One delivery day's tables, each at a path below the root, and where they came from.

    ``arrived_at`` (seconds since 1970, of the newest file) and ``arrival`` order deliveries of a
    day; ``source`` is "batch" or "stream". ``rows`` counts each table's rows.
    """

    delivery_day: str | None
    tables: dict[str, str]
    rows: dict[str, int] = field(default_factory=dict)
    source: str = "batch"
    arrival: str | None = None
    arrived_at: float | None = None
    digest: str | None = None
    number: int = 0


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, place = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def new_version() -> str:
    return uuid.uuid4().hex


def home(spark: SparkSession, path: str) -> tuple[str, str]:
    """Root and name of the table at ``path``: of a set of tables, or a root of its own (name "")."""
    path = path.rstrip("/")
    above, _, name = path.rpartition("/")
    if not exists(spark, f"{path}/{FOLDER}") and exists(spark, f"{above}/{FOLDER}"):
        return above, name
    return path, ""


def place(root: str, table: str) -> str:
    return f"{root}/{table}" if table else root


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """All publications: delivery_day, number, tables, rows, source, arrival, arrived_at, digest."""
    found = [n for n in names(spark, f"{root}/{FOLDER}") if n.endswith(".json")]
    if not found:
        return spark.createDataFrame([], LINES)
    return spark.read.schema(LINES).json([f"{root}/{FOLDER}/{n}" for n in found])


def publications(spark: SparkSession, root: str) -> list[Publication]:
    """The ledger in order of publication."""
    rows = ledger(spark, root).orderBy("number", "delivery_day").collect()
    return [Publication(**r.asDict()) for r in rows]


def current(found: Iterable[Publication]) -> dict[tuple[str | None, str], Publication]:
    """The last publication of each delivery day and table."""
    return {(p.delivery_day, table): p for p in found for table in p.tables}


def publish(spark: SparkSession, root: str, lines: list[Publication]) -> None:
    """Make the tables of ``lines`` visible, all at once.

    What an older version of this library stored without manifests is listed first. One writer
    a root at a time is assumed; of two, the later number or else name counts.
    """
    folder = f"{root}/{FOLDER}"
    done = [n for n in names(spark, folder) if n.endswith(".json")]
    if not done:
        lines = [*_unlisted(spark, root), *lines]
    number = max((int(n.split("-")[0]) for n in done), default=0) + 1
    text = "".join(json.dumps(asdict(p) | {"number": number}) + "\n" for p in lines)
    name = f"{number:012d}-{new_version()}.json"
    files, aside = _files(spark, f"{folder}/.{name}")
    out = files.create(aside, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if not files.rename(aside, _files(spark, f"{folder}/{name}")[1]):
        raise OSError(f"{folder}/{name} cannot be put in place")


def _unlisted(spark: SparkSession, root: str) -> list[Publication]:
    lines = []
    for table in ("", *names(spark, root)):
        days = [n for n in names(spark, place(root, table)) if n.startswith(f"{DELIVERY}=")]
        lines += [
            Publication(_day(n), {table: f"{table}/{n}".lstrip("/")}, source="unlisted") for n in days
        ]
    return lines


def _day(name: str) -> str | None:
    day = name.partition("=")[2]
    return None if day.startswith("__HIVE") else day


def paths(spark: SparkSession, root: str, table: str) -> list[str]:
    """Folders of the table's present deliveries, below the root.

    A version of which all deliveries are present counts as one folder.
    """
    found = publications(spark, root)
    present = {p.tables[table] for (_, name), p in current(found).items() if name == table}
    by_version: dict[str, set[str]] = {}
    for path in {p.tables[table] for p in found if table in p.tables}:
        by_version.setdefault(path.rpartition("/")[0], set()).add(path)
    folders: set[str] = set()
    for version, deliveries in by_version.items():
        whole = VERSION + "=" in version and deliveries <= present
        folders |= {version} if whole else deliveries & present
    return sorted(folders)


def delivery_days(spark: SparkSession, root: str, table: str) -> set[tuple[str | None, int]]:
    """Delivery days of a table, each with the number of its publication."""
    now = current(publications(spark, root))
    return {(p.delivery_day, p.number) for (_, name), p in now.items() if name == table}


def side_paths(spark: SparkSession, root: str, table: str) -> list[str]:
    """Folders of ``rejected`` or ``accounts``: of all publications of which some table is present."""
    found = publications(spark, root)
    present = {
        (p.delivery_day, p.number) for (_, name), p in current(found).items() if name not in (REJECTED, ACCOUNTS)
    }
    return sorted(p.tables[table] for p in found if table in p.tables and (p.delivery_day, p.number) in present)


def read(spark: SparkSession, schema: str, root: str, table: str, found: list[str]) -> DataFrame:
    """Rows of the folders ``found`` of a table; ``schema`` ends with the delivery day."""
    base = place(root, table)
    listed = [p for p in found if f"{VERSION}=" in p]
    older = [p for p in found if f"{VERSION}=" not in p]
    frames = []
    for some, more in ((listed, f", {VERSION} string"), (older, "")):
        if some:
            part = spark.read.schema(schema + more).option("basePath", base).parquet(*(f"{root}/{p}" for p in some))
            frames.append(part.drop(VERSION))
    if not frames:
        return spark.createDataFrame([], schema)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def expire(spark: SparkSession, root: str) -> list[str]:
    """Delete versions that no present delivery uses; to be run while nobody reads older ones.

    Publications older than the present ones stay in the ledger. Also removes what stopped jobs
    left, so no delivery may be on its way.
    """
    kept = {p.tables[name] for (_, name), p in current(publications(spark, root)).items()}
    kept |= {path for side in (REJECTED, ACCOUNTS) for path in side_paths(spark, root, side)}
    gone = []
    for table in ("", *names(spark, root)):
        for version in names(spark, place(root, table)):
            if version.startswith(f"{VERSION}="):
                below = f"{table}/{version}".lstrip("/")
                for day in names(spark, f"{root}/{below}"):
                    if day.startswith(f"{DELIVERY}=") and f"{below}/{day}" not in kept:
                        remove(spark, f"{root}/{below}/{day}")
                        gone.append(f"{below}/{day}")
    return gone
