"""trialweave.functions"""
