"""trialweave.operators"""
