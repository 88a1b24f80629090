from servicelens.plans.runs import cli

cli()
