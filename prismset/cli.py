"""python -m prismset.cli --config FILE [--input DIR] [--output DIR] [--seed N] [--validate-only] [--stage STAGE]"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from prismset.config import STAGES, check


def main(args: list[str] | None = None) -> int:
    import yaml

    p = argparse.ArgumentParser(description="Prepare an object-detection dataset with Spark.")
    p.add_argument("--config", required=True)
    p.add_argument("--input")
    p.add_argument("--output")
    p.add_argument("--seed", type=int)
    p.add_argument("--validate-only", action="store_true")
    p.add_argument("--stage", choices=STAGES)
    a = p.parse_args(args)
    path = Path(a.config)
    if not path.exists():
        print(f"no configuration at {path}", file=sys.stderr)
        return 1
    config = yaml.safe_load(path.read_text())
    for key, value in (("input_path", a.input), ("output_path", a.output)):
        if value:
            config[key] = value
    if a.seed is not None:
        config.setdefault("split", {})["seed"] = a.seed
    try:
        config = check(config)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    from prismset.plans import dataset
    from prismset.session import get_session

    print(json.dumps(dataset.run(get_session("prismset"), config, "validation" if a.validate_only else a.stage), indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
