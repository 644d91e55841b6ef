"""Print the formatted physical plans of the headline stages (for plan review)."""

import sys

sys.path.insert(0, "/root/repo")

from picsel.operators import metrics as E  # noqa: E402
from picsel.plans.recommend import RecommendationRun  # noqa: E402
from picsel.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    run = RecommendationRun.standin(spark, sf)
    t = run.tables
    from picsel.operators import pool as P
    stages = {
        "unillustrated_pages (B7)": P.unillustrated_pages(t.page, t.item_page_link, run.illustrated),
        "item_claims (B8)": P.item_claims(t.entity, run.unillustrated),
        "numbered_category_images": P.numbered_category_images(run.pool.category_files),
        "top_candidates (C8)": run.top_candidates(),
        "column_frequencies (E20)": E.column_frequencies(run.production_table("x", 0.0)),
    }
    for name, df in stages.items():
        print("=" * 100)
        print(name)
        df.explain("formatted")


if __name__ == "__main__":
    main()
