"""Control-plane files: JSON, digests, archives, manifests. These are small, or read in blocks by the driver."""

from __future__ import annotations

import hashlib
import json
import re
import zipfile
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

from ..functions.text import ADDRESS_MAPPINGS, NAME_MAPPINGS, SUFFIXES
from . import storage

# Names and formats of input files, teams and configurations.
VERSION = "hybrid-v2"
_NAME = re.compile(r"^(train|test)_(source[123]|ground_truth)(\(\d+\))?\.tsv$", re.I)
_TEAM = re.compile(r"[A-Za-z0-9_-]+")


# ---------------------------------------------------------------- JSON and configuration


def dump_json(path: str, value) -> None:
    """Writes JSON under another name, then renames it (K3)."""
    storage.write(path, [json.dumps(value, indent=2, ensure_ascii=False).encode()])


def read_json(path: str):
    return json.loads(storage.read(path))


@dataclass(frozen=True)
class Config:
    """Parameters of a run, with their defaults."""

    version: str = VERSION
    seed: int = 42
    sample_size: int = 20_000
    name_mappings: dict[str, str] = field(default_factory=lambda: dict(NAME_MAPPINGS))
    address_mappings: dict[str, str] = field(default_factory=lambda: dict(ADDRESS_MAPPINGS))
    suffixes: tuple[str, ...] = SUFFIXES
    street: bool = False
    transliterate: bool = True
    ngrams: tuple[int, int] = (3, 5)
    min_df: int = 2
    max_features: int = 150_000
    #: Rows that the vocabulary is taken from; 0 for all.
    vocabulary_rows: int = 0
    tfidf_k: int = 20
    bm25_k: int = 20
    max_tokens: int = 16
    final_k: int = 20
    pilot_caps: tuple[int, ...] = (20, 50)
    recall_floor: float = 0.93
    threshold_steps: int = 201
    trees: int = 200
    learning_rate: float = 0.05
    min_rows: int = 20

    def digest(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


def load_config(path: str) -> Config:
    """Reads a configuration; another version is refused."""
    values = read_json(path)
    if values.get("version") != VERSION:
        raise ValueError(f"configuration version {values.get('version')!r} is not {VERSION!r}")
    return Config(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


# ---------------------------------------------------------------- digests and manifests


def file_stats(path: str) -> dict:
    """sha256, bytes and physical lines; a last line without its end counts."""
    digest, size, lines, last = hashlib.sha256(), 0, 0, b"\n"
    for block in storage.blocks(path):
        digest.update(block)
        size += len(block)
        lines += block.count(b"\n")
        last = block[-1:]
    return {"sha256": digest.hexdigest(), "bytes": size, "physical_lines": lines + (last != b"\n")}


def fingerprint(folder: str, split: str) -> dict:
    """Digest and size of a split's inputs."""
    names = [f"{split}_source{n}.tsv" for n in (1, 2, 3)] + ([f"{split}_ground_truth.tsv"] if split == "train" else [])
    return {name: {k: v for k, v in file_stats(f"{folder}/{name}").items() if k != "physical_lines"} for name in names}


def require_same_manifest(path: str, manifest: dict) -> bool:
    """Whether path holds this manifest; writes it if there is none, refuses another."""
    value = json.loads(json.dumps(manifest))
    if not storage.exists(path):
        dump_json(path, value)
        return False
    if read_json(path) != value:
        raise ValueError(f"{path} belongs to another input or configuration")
    return True


# ---------------------------------------------------------------- input files


def canonical_name(name: str) -> str | None:
    """The plain name of an input file, without folders and copy numbers; None for other files."""
    m = _NAME.match(name.replace("\\", "/").rsplit("/", 1)[-1])
    return f"{m[1]}_{m[2]}.tsv".lower() if m else None


def _archive(source: str) -> zipfile.ZipFile | None:
    at = storage._local(source)
    return zipfile.ZipFile(at) if at is not None and zipfile.is_zipfile(at) else None


def discover(source: str) -> dict[str, str]:
    """Canonical name to member or path in a ZIP file of this machine or a folder, searched recursively."""
    archive = _archive(source)
    if archive is None:
        members = storage.files(source)
    else:
        with archive:
            members = [x.filename for x in archive.infolist() if not x.is_dir()]
    out: dict[str, str] = {}
    for member in members:
        name = canonical_name(member)
        if name is None:
            continue
        if name == "test_ground_truth.tsv":
            raise ValueError("labels of the test split are not expected")
        if name in out:
            raise ValueError(f"several copies of {name}")
        out[name] = member
    return out


def _member(archive: zipfile.ZipFile, name: str) -> Iterator[bytes]:
    with archive.open(name) as f:
        while block := f.read(storage.BLOCK):
            yield block


def prepare(source: str, output: str, split: str = "train") -> dict:
    """Copies a split's files byte for byte; equal files that exist stay, others are refused."""
    found = discover(source)
    wanted = [f"{split}_source{n}.tsv" for n in (1, 2, 3)] + ([f"{split}_ground_truth.tsv"] if split == "train" else [])
    if missing := [x for x in wanted if x not in found]:
        raise ValueError(f"missing: {', '.join(missing)}")
    archive = _archive(source)
    manifest = {}
    try:
        for name in wanted:
            target, hidden = f"{output}/{name}", f"{output}/{name}.copying"
            storage.write(hidden, _member(archive, found[name]) if archive else storage.blocks(found[name]))
            stats = file_stats(hidden)
            if storage.exists(target) and file_stats(target) != stats:
                storage.remove(hidden)
                raise ValueError(f"{target} differs from input")
            storage.rename(hidden, target)
            manifest[name] = stats
    finally:
        if archive:
            archive.close()
    dump_json(f"{output}/manifest.json", manifest)
    return manifest


#: What each kind of run puts beside its two result files: nothing, a model, or a model and configurations.
MODES = ("lists", "model", "hybrid")


def check_team(team: str) -> None:
    if not _TEAM.fullmatch(team):
        raise ValueError("a team's name has letters, digits, _ and - only")


def pack(destination: str, team: str, mode: str, results: list[str], model: list[str] = (), configs: list[str] = (), documents: list[str] = (), code: str = "code/solution") -> str:
    """A ZIP in the fixed layout; the lists are expected to be validated already (see plans.linkage.package, K12)."""
    import io

    check_team(team)
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    if (mode == "lists") == bool(model):
        raise ValueError("a model goes with the modes that have one")
    base = lambda x: x.rsplit("/", 1)[-1]
    places = [(x, f"output/{base(x)}") for x in results] + [(x, f"{code}/artifacts/{base(x)}") for x in model]
    places += [(x, f"{code}/configs/{base(x)}") for x in configs if mode == "hybrid"] + [(x, f"{code}/{base(x)}") for x in documents]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for source, name in places:
            with z.open(name, "w", force_zip64=True) as f:
                for block in storage.blocks(source):
                    f.write(block)
    path = f"{destination}/" + ("submission.zip" if mode == "hybrid" else f"{team}_submission.zip")
    storage.write(path, [held.getvalue()])
    return path
