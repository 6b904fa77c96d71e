"""trialweave.plans"""
