"""Ready-made plans: adapters from general tables, registered queries, workflows."""
