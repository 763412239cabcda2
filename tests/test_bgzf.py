"""Blocked gzip: many tasks on one file, lines as in plain text, damage raises."""

import gzip
import random

import pytest

from locuswave.session import build_session  # noqa: F401
from locuswave.sinks import tables as sink
from locuswave.sources import bgzf, sequences
from locuswave.sources.text_lines import numbered_lines, split_lines


def pack(text: bytes, rng: random.Random, largest: int = 400) -> bytes:
    """Members of random sizes, empty ones too."""
    out, at = b"", 0
    while at < len(text):
        size = rng.choice([0, 1, rng.randint(2, largest)])
        out += bgzf.make_member(text[at:at + size])
        at += size
    return out + bgzf.END_MARKER


def texts(rng):
    lines = ["".join(rng.choice("ACGTé \r") for _ in range(rng.choice([0, 0, 3, 40, 700]))) for _ in range(120)]
    return ["\n".join(lines) + "\n", "\n".join(lines), "\n\n\n", "one line", "x" * 5000, ""]


def parts(data: bytes, step: int, tmp_path):
    path = tmp_path / "x.bgz"
    path.write_bytes(data)
    out = []
    for start in range(0, len(data), step):
        with open(path, "rb") as file:
            out.append(list(bgzf.Members(file, str(path), len(data)).lines(start, min(start + step, len(data)))))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_any_split_gives_the_lines_of_the_text(seed, tmp_path):
    rng = random.Random(seed)
    for text in texts(rng):
        data = pack(text.encode(), rng)
        assert gzip.decompress(data).decode() == text
        want = [line.removesuffix("\r") for line in text.split("\n")]
        want = want[:-1] if not want[-1] else want
        for step in (29, 97, 300, 1000, 10 ** 7):
            assert [line for part in parts(data, step, tmp_path) for line in part] == want


def test_damage_raises_wherever_it_is(tmp_path):
    rng = random.Random(2)
    text = "".join(f"line {k} {rng.random()}\n" for k in range(300)).encode()
    data = pack(text, rng)
    want = text.decode().split("\n")[:-1]
    for _ in range(150):
        at, wrong = rng.randrange(len(data)), bytearray(data)
        wrong[at] ^= 1 << rng.randrange(8)
        try:
            got = [line for part in parts(bytes(wrong), 500, tmp_path) for line in part]
        except ValueError:
            continue
        # Some header bytes (time, flags of the packer) carry nothing.
        assert got == want
    with pytest.raises(ValueError, match="block at byte"):
        parts(data[:-40], 500, tmp_path)


def test_one_large_fastq_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    reads = [(f"r{k}", "".join(rng.choice("ACGTN") for _ in range(60)), "".join(rng.choice("#5I") for _ in range(60)))
             for k in range(2000)]
    text = "".join(f"@{n} lane\n{s}\n+\n{q}\n" for n, s, q in reads).encode()
    for name in ("a.fastq.gz", "b.fastq.bgz"):
        (tmp_path / name).write_bytes(pack(text, rng, 60_000))
    (tmp_path / "plain.fastq.gz").write_bytes(gzip.compress(text[:3000]) + gzip.compress(text[3000:]))
    (tmp_path / "text.fastq").write_bytes(text)
    assert split_lines(spark, [str(tmp_path / "a.fastq.gz")], 5000).rdd.getNumPartitions() > 10
    assert split_lines(spark, [str(tmp_path / "plain.fastq.gz")], 5000).rdd.getNumPartitions() == 1
    want = [tuple(r) for r in numbered_lines(spark, [str(tmp_path / "text.fastq")]).orderBy("line_no").select("line_no", "line").collect()]
    for name in ("a.fastq.gz", "b.fastq.bgz", "plain.fastq.gz"):
        got = numbered_lines(spark, [str(tmp_path / name)], 5000).orderBy("line_no").select("line_no", "line")
        assert [tuple(r) for r in got.collect()] == want
    sheet = spark.createDataFrame([("s", str(tmp_path / "a.fastq.gz"), str(tmp_path / "b.fastq.bgz"))], "sample_id string, fastq_1 string, fastq_2 string")
    got = sequences.read_fastq(spark, sheet, 5000).collect()
    assert sorted((r.read_id, r.seq1, r.qual2) for r in got) == sorted(reads)
    damaged = bytearray((tmp_path / "a.fastq.gz").read_bytes())
    damaged[len(damaged) // 2] ^= 4
    (tmp_path / "bad.fastq.gz").write_bytes(damaged)
    with pytest.raises(Exception, match="damaged"):
        split_lines(spark, [str(tmp_path / "bad.fastq.gz")], 5000).count()


def test_blocked_fasta_and_signal(spark, tmp_path):
    rng = random.Random(6)
    genome = {"chr1": "".join(rng.choice("ACGT") for _ in range(4000)), "chr2": "ACG", "chr3": "T" * 999}
    text = "".join(f">{k}\n" + "".join(s[i:i + 70] + "\n" for i in range(0, len(s), 70)) for k, s in genome.items())
    (tmp_path / "g.fa.gz").write_bytes(pack(text.encode(), rng))
    got = {}
    for r in sequences.read_fasta(spark, str(tmp_path / "g.fa.gz"), 128, split_bytes=700).orderBy("chrom", "chunk_id").collect():
        got[r.chrom] = got.get(r.chrom, "") + r.seq
    assert got == genome
    from locuswave.sources.tables import read_signal
    (tmp_path / "s.tsv.bgz").write_bytes(pack(b"#chromosome\tstart\tend\ta\nchr1\t1\t5\t2.5\nchr2\t0\t3\t1\n", rng))
    assert sorted(map(tuple, read_signal(spark, str(tmp_path / "s.tsv.bgz"), "g").collect())) == [
        ("g", "chr1", 1, 5, 2.5), ("g", "chr2", 0, 3, 1.0)]


def test_written_fastq_reads_back(spark, tmp_path):
    pairs = spark.createDataFrame(
        [(f"s{k % 2}/=%", f"r{k}", f"ACG{k}", f"III{k}", f"T{k}", f"#{k}") for k in range(500)],
        "sample_id string, read_id string, seq1 string, qual1 string, seq2 string, qual2 string")
    sink.write_fastq(pairs, str(tmp_path / "fq"))
    sheet = sink.fastq_sheet(spark, str(tmp_path / "fq"))
    assert sheet.filter("fastq_1 is null or fastq_2 is null").count() == 0 and sheet.count() >= 2
    got = sequences.read_fastq(spark, sheet, 300).select(*pairs.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pairs.collect()))
    assert not (tmp_path / "fq" / "_attempts").exists()
