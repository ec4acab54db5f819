"""From files to answers by the command line."""

import json

from siltstone.__main__ import main


def lines(capsys):
    return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]


def test_end_to_end(spark, tmp_path, capsys):
    tree = tmp_path / "repo"
    skill = "---\nname: {0}\ndescription: Use when you chart {1} files and compare the versions of reports\nlicense: MIT\n---\n# {0}\ntext {1}\n"
    for name, topic in (("maps", "map"), ("tides", "tide"), ("bread", "recipe")):
        (tree / "skills" / name / "scripts").mkdir(parents=True)
        (tree / "skills" / name / "SKILL.md").write_text(skill.format(name, topic))
        (tree / "skills" / name / "scripts" / "run.py").write_text("x = 1\n")
    (tree / "skills" / "empty").mkdir()
    (tree / "skills" / "empty" / "skill.md").write_text("no frontmatter, the first stop")
    (tree / "LICENSE").write_text("terms")
    (tree / "README.md").write_text("see https://github.com/a/skills and https://github.com/known/repo\n<!-- stats:start --><!-- stats:end -->")
    (tmp_path / "sources.json").write_text(json.dumps({"repositories": [{"id": "src", "url": "https://github.com/known/repo", "owner_type": "vendor", "tier": 1}]}))
    run = lambda *a: main([str(x) for x in a])

    run("ingest", tree, "src", tmp_path / "raw", "--now", "2026-01-01T00:00:00+00:00")
    raw = spark.read.json(str(tmp_path / "raw"))
    assert raw.count() == 4 and raw.where("has_scripts").count() == 3 and raw.where("license_files[0].path = 'LICENSE'").count() == 4
    # JSON parts in the crawl's own file naming
    (tmp_path / "crawl").mkdir()
    (tmp_path / "crawl" / "src.jsonl").write_text("\n".join(r.value for r in spark.read.text(str(tmp_path / "raw")).collect()) + "\nbroken\n\n")

    run("build", tmp_path / "crawl", tmp_path / "sources.json", tmp_path / "out", "--now", "2026-01-02T00:00:00+00:00")
    built = {r.id: r for r in spark.read.parquet(str(tmp_path / "out/catalog")).collect()}
    assert set(built) == {f"github.com/known/repo/skills/{n}" for n in ("maps", "tides", "bread")}
    assert all(r.trust_tier == "official" and r.license.spdx == "MIT" and r.fm.strict and r.security.capabilities == ["shell"] for r in built.values())
    assert {r.type for r in spark.read.json(str(tmp_path / "out/changes")).collect()} == {"added"}

    capsys.readouterr()
    run("stats", tmp_path / "out/catalog", "--repositories", 1, "--readme", tree / "README.md")
    assert "**Total skills indexed:** [3]" in capsys.readouterr().out and "[3]" in (tree / "README.md").read_text()
    run("index", tmp_path / "out/catalog", tmp_path / "index")
    run("find", tmp_path / "index", "charting tides", "--license", "permissive")
    assert [r["id"] for r in lines(capsys)] == ["github.com/known/repo/skills/tides"]
    run("show", tmp_path / "index", "github.com/known/repo/skills/maps")
    assert lines(capsys)[0]["name"] == "maps"
    run("lint-skill", tree, "--lenient")
    assert sum(r["strict"] for r in lines(capsys)) == 3
    run("wording", tree)
    assert {r["path"] for r in lines(capsys)} == {"skills/empty/skill.md"}
    run("scan-security", tree)
    assert len(lines(capsys)) == 9
    run("dedup", tmp_path / "out/catalog")
    assert lines(capsys)[0]["distinct_keys"] == 3
    run("discover", tree, tmp_path / "sources.json", tmp_path / "candidates")
    assert [r.repo_url for r in spark.read.json(str(tmp_path / "candidates")).collect()] == ["https://github.com/a/skills"]
    (tmp_path / "known.jsonl").write_text('{"type": "repo", "reference": "https://github.com/a/skills", "exists": true}')
    run("check-refs", tree, tmp_path / "known.jsonl")
    assert {r["path"]: r["dangling"] for r in lines(capsys)} == {"README.md": 1}
    (tmp_path / "seeds.json").write_text(json.dumps({"seeds": [{"id": "x", "url": "u", "owner_type": "vendor (y)", "tier": 1}]}))
    run("import-sources", tmp_path / "seeds.json", tmp_path / "seeded")
    assert spark.read.json(str(tmp_path / "seeded")).first().owner_type == "vendor"

    run("lint-quality", tree)
    assert {r["path"]: r["passes"] for r in lines(capsys)} == {**{f"skills/{n}/SKILL.md": True for n in ("maps", "tides", "bread")}, "skills/empty/skill.md": False}
    run("shards", tmp_path / "out/catalog", tmp_path / "shards")
    shard = spark.read.json(str(tmp_path / "shards"))
    assert shard.count() == 3 and {r.shard for r in shard.collect()} == {"official"} and "maps" in {k for r in shard.collect() for k in r.kw}
    assert json.loads((tmp_path / "out/stats.json").read_text())["total_skills"] == 3
    assert spark.read.text(str(tmp_path / "out/json/records")).count() == 3
    curated = spark.read.parquet(str(tmp_path / "out/catalog")).selectExpr("* except (layer)", "'curated' as layer", "'curated/' || name as curated_path")
    curated.write.parquet(str(tmp_path / "curated"))
    (tmp_path / "files/curated/maps").mkdir(parents=True)
    (tmp_path / "files/curated/maps/LICENSE").write_text("MIT")
    run("check-curated-gate", tmp_path / "curated", tmp_path / "files", tmp_path / "checked")
    failing = {r["skill_id"][-5:]: r["reasons"] for r in lines(capsys)}
    assert failing == {n: ["Missing LICENSE file in curated directory"] for n in ("tides", "bread")}
    assert {r.name: r.status for r in spark.read.parquet(str(tmp_path / "checked")).collect()} == {"maps": "active", "tides": "review", "bread": "review"}
    (tmp_path / "owners.jsonl").write_text('{"owner": "somebody"}')
    (tmp_path / "verdicts.jsonl").write_text('{"id": "github.com/known/repo/skills/maps", "verdict": "malicious"}')
    run("build", tmp_path / "crawl", tmp_path / "sources.json", tmp_path / "out2", "--previous", tmp_path / "out/catalog", "--owners", tmp_path / "owners.jsonl", "--verdicts", tmp_path / "verdicts.jsonl")
    again = spark.read.parquet(str(tmp_path / "out2/catalog")).collect()
    assert {(r.status, r.status_reason) for r in again} == {("dangling", "source_owner_deleted")} and {r.name for r in again if r.security.status == "malicious"} == {"maps"}
