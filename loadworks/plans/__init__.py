"""End-to-end load flows and the registered query recipes.

Importing ``loadworks.plans.catalog`` registers every recipe.
"""
