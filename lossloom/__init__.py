"""Claims analytics as Spark jobs: wide claim features, note mining, referral scoring and weekly triage."""
